"""Registered queries: text cleaning, tagging, taxonomy, embedding topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubbub.functions import text
from hubbub.operators import topics
from hubbub.plans.registry import query
from hubbub.plans.sample_views import AS_OF, duckdb_sql
from hubbub.session import saved


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _replace(expression: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({expression}, {_quoted(pattern)}, '{by}', 'g')"


# The symbol ranges one by one, where the Spark form has their union.
_SYMBOL_BLOCKS = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2500}-\x{2BEF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{1F926}-\x{1F937}"
    r"\x{10000}-\x{10FFFF}\x{2640}-\x{2642}\x{2600}-\x{2B55}"
    r"\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}"
)


def _clean(column: str) -> str:
    step = _replace(column, rf"[{_SYMBOL_BLOCKS}]+|{text.URL}|[\x{{0E00}}-\x{{0E7F}}']")
    step = _replace(step, f"[{text.PUNCTUATION}{text.BULLETS}]", " ")
    step = _replace(step, "r/", " ")
    return f"trim({_replace(step, f'[{text.SPACES}]+', ' ')})"


def _clean_v2(column: str) -> str:
    token = text.URL_TOKEN
    step = _replace(column, rf"((http|https)://)?[{token}]+\.([a-zA-Z]){{2,6}}([{token}&])*")
    step = _replace(step, rf"#{text.WORD}+")
    step = _replace(step, r"\n+")
    step = _replace(step, rf"(?s)\p{{Nd}}+.*?[{text.FACES}]")
    step = _replace(step, " +", " ")
    spaces = text.SPACES
    return _replace(step, rf"\A[{spaces}]+|[{spaces}]+\z")


_HITS = ", ".join(
    f"len(list_intersect(tokens, {list(words)!r})) AS hits_{language}"
    for language, words in text.STOP_WORDS.items()
)
_BEST = f"greatest({', '.join(f'hits_{language}' for language in text.STOP_WORDS)})"
_CASES = " ".join(f"WHEN hits_{name} = {_BEST} THEN '{name}'" for name in text.STOP_WORDS)


def _tagged(source: str) -> str:
    """Common tables from ``source`` to ``l``, which adds ``cleaned`` and ``tag``."""
    bare = _replace(_replace("cleaned", text.URL), rf"#{text.WORD}+[{text.SPACES}]*")
    bare = _replace(bare, text.EMOJI_PLANE)
    tokens = f"list_distinct(regexp_split_to_array(lower({bare}), '[^\\p{{L}}]+'))"
    return f"""
c AS MATERIALIZED (SELECT *, {_clean('message')} AS cleaned FROM {source}),
tk AS MATERIALIZED (SELECT *, {tokens} AS tokens FROM c),
hs AS MATERIALIZED (SELECT * EXCLUDE (tokens), {_HITS} FROM tk),
l AS (
  SELECT *, CASE WHEN regexp_matches(message, {_quoted(text.THAI)}) THEN 'th'
    WHEN {_BEST} = 0 THEN 'n/a' {_CASES} END AS tag FROM hs)"""


def _one_column(expression: str, name: str) -> str:
    return duckdb_sql(f"SELECT content_id, {expression} AS {name} FROM fx_messages", "messages")


def _apply(v, function, name):
    return v.messages.select("content_id", function(F.col("message")).alias(name))


@query(_one_column(_clean("message"), "cleaned"))
def clean_message(v):
    return _apply(v, text.clean_message, "cleaned")


@query(_one_column(_clean_v2("message"), "cleaned"))
def clean_message_v2(v):
    return _apply(v, text.clean_message_v2, "cleaned")


@query(_one_column(_replace("message", text.URL), "cleaned"))
def strip_urls(v):
    return _apply(v, text.strip_urls, "cleaned")


@query(_one_column(_replace("message", rf"#{text.WORD}+[{text.SPACES}]*"), "cleaned"))
def strip_hashtags(v):
    return _apply(v, text.strip_hashtags, "cleaned")


@query(_one_column(_replace("message", text.EMOJI_PLANE), "cleaned"))
def strip_emojis(v):
    return _apply(v, text.strip_emojis, "cleaned")


@query(
    duckdb_sql(f"WITH {_tagged('fx_messages')} SELECT content_id, tag AS language FROM l", "messages")
)
def language_tag(v):
    return _apply(v, text.language_tag, "language")


@query(
    duckdb_sql(
        f"""
SELECT content_id, CAST(len(string_split({_clean('message')}, ' ')) AS INTEGER) AS tokens,
  len(string_split({_clean('message')}, ' ')) >= 21 AS classifiable FROM fx_messages""",
        "messages",
    )
)
def classifiable(v):
    cleaned = text.clean_message(F.col("message"))
    return v.messages.select(
        "content_id",
        text.token_count(cleaned).alias("tokens"),
        text.classifiable(cleaned).alias("classifiable"),
    )


_SLUGS = (
    "list_transform(string_split(regexp_replace(category, '^/', ''), '/'), "
    "lambda x: lower(regexp_replace(replace(x, '&', 'and'), '\\s+', '-', 'g')))"
)


@query(
    duckdb_sql(
        f"""
SELECT content_id, array_to_string({_SLUGS}, '|') AS slugs FROM fx_messages
WHERE category IS NOT NULL""",
        "messages",
    )
)
def topic_slugs(v):
    found = v.messages.where(F.col("category").isNotNull())
    return found.select(
        "content_id", F.array_join(text.topic_slugs(F.col("category")), "|").alias("slugs")
    )


_TAGGED = f"""
tr AS (SELECT *, {_clean('translated_en')} AS translation FROM fx_messages),
{_tagged('tr')},
r AS (
  SELECT *, tag = 'en' AS own, CASE WHEN tag = 'en' THEN len(string_split(cleaned, ' ')) >= 21
    ELSE coalesce(len(string_split(translation, ' ')) >= 21, FALSE) END AS ready FROM l),
tm AS (
  SELECT content_id, CASE WHEN own THEN tag ELSE coalesce(detected_language, tag) END AS language,
    CASE WHEN ready AND category IS NOT NULL THEN {_SLUGS} END AS slugs,
    CASE WHEN NOT own AND ready THEN translation END AS translated_en, updated_at FROM r)"""


@query(
    duckdb_sql(
        f"""
WITH {_TAGGED}
SELECT * REPLACE (array_to_string(slugs, '|') AS slugs) FROM tm""",
        "messages",
    )
)
def tag_messages(v):
    return topics.tag_messages(v.messages).withColumn("slugs", F.array_join("slugs", "|"))


def _stored_topics(v):
    node = "array<struct<_id:string,slug:string>>"
    return v.topics.withColumns(
        {"parents": F.lit(None).cast(node), "children": F.lit(None).cast(node)}
    )


_TAXONOMY = f"""{_TAGGED},
st AS (
  SELECT slugs, updated_at, unnest(range(1, len(slugs) + 1)) AS i FROM tm WHERE slugs IS NOT NULL),
ed AS (
  SELECT slugs[i] AS slug, CASE WHEN i > 1 THEN slugs[i - 1] END AS parent,
    CASE WHEN i < len(slugs) THEN slugs[i + 1] END AS child, updated_at FROM st),
tc AS (
  SELECT slug, min(updated_at) AS first, max(updated_at) AS latest,
    list(DISTINCT parent) FILTER (parent IS NOT NULL) AS ps,
    list(DISTINCT child) FILTER (child IS NOT NULL) AS chs FROM ed GROUP BY slug),
mg AS (
  SELECT tc.slug, coalesce(t.topic_id, substr(md5(tc.slug), 1, 24)) AS topic_id,
    list_sort(list_distinct(list_concat(coalesce(t.parents_slug, []), coalesce(ps, [])))) AS ps,
    list_sort(list_distinct(list_concat(coalesce(t.children_slug, []), coalesce(chs, [])))) AS chs,
    coalesce(t.created_at, first) AS created_at, latest AS updated_at
  FROM tc LEFT JOIN fx_topics t ON tc.slug = t.slug),
ids AS (
  SELECT slug, topic_id FROM mg UNION ALL
  SELECT slug, topic_id FROM fx_topics WHERE slug NOT IN (SELECT slug FROM mg)),
pn AS (
  SELECT m.slug, string_agg(i.topic_id || ':' || i.slug, ',' ORDER BY i.topic_id, i.slug) AS nodes
  FROM (SELECT slug, unnest(ps) AS other FROM mg) m JOIN ids i ON m.other = i.slug GROUP BY 1),
cn AS (
  SELECT m.slug, string_agg(i.topic_id || ':' || i.slug, ',' ORDER BY i.topic_id, i.slug) AS nodes
  FROM (SELECT slug, unnest(chs) AS other FROM mg) m JOIN ids i ON m.other = i.slug GROUP BY 1)"""


@query(
    duckdb_sql(
        f"""
WITH {_TAXONOMY}
SELECT mg.topic_id, mg.slug, coalesce(pn.nodes, '') AS parents,
  coalesce(cn.nodes, '') AS children, array_to_string(ps, ',') AS parents_slug,
  array_to_string(chs, ',') AS children_slug, created_at, updated_at
FROM mg LEFT JOIN pn ON mg.slug = pn.slug LEFT JOIN cn ON mg.slug = cn.slug""",
        "messages",
        "topics",
    )
)
def topic_taxonomy(v):
    found = topics.topic_taxonomy(topics.tag_messages(v.messages), _stored_topics(v))

    def nodes(column):
        return F.array_join(F.transform(column, lambda n: F.concat(n["_id"], F.lit(":"), n["slug"])), ",")

    return found.withColumns(
        {
            "parents": nodes("parents"),
            "children": nodes("children"),
            "parents_slug": F.array_join("parents_slug", ","),
            "children_slug": F.array_join("children_slug", ","),
        }
    )


CONTENT_TOPICS_SQL = duckdb_sql(
    f"""
WITH {_TAXONOMY},
pt AS (
  SELECT u.content_id, string_agg(ids.topic_id, ',' ORDER BY u.i) AS topics
  FROM (SELECT content_id, slugs, unnest(range(1, len(slugs) + 1)) AS i FROM tm) u
  JOIN ids ON ids.slug = u.slugs[u.i] GROUP BY u.content_id)
SELECT tm.content_id, language, pt.topics, translated_en, @t0 AS updated_at
FROM tm LEFT JOIN pt ON tm.content_id = pt.content_id""",
    "messages",
    "topics",
)


@query(CONTENT_TOPICS_SQL)
def content_topics(v):
    tagged = saved(topics.tag_messages(v.messages))
    taxonomy = topics.topic_taxonomy(tagged, _stored_topics(v)).select("slug", "topic_id")
    found = topics.content_topics(tagged, taxonomy, AS_OF)
    return found.withColumn("topics", F.array_join("topics", ","))


@query(
    duckdb_sql(
        "SELECT content_id, language FROM fx_filtering WHERE class IS NULL",
        "filtering",
    )
)
def untagged(v):
    return topics.untagged(v.filtering).select("content_id", "language")


@query(
    duckdb_sql(
        """
WITH d AS (
  SELECT e.vec_id, t.topic,
    list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])) AS dot
  FROM embeddings e CROSS JOIN fx_topic_vectors t),
b AS (SELECT vec_id, max(dot) AS dot, arg_max(topic, dot) AS topic FROM d GROUP BY vec_id)
SELECT vec_id, CASE WHEN dot >= 0.15 THEN topic ELSE 'etc' END AS class,
  CASE WHEN dot >= 0.15 THEN round(dot, 2) ELSE 0 END AS score FROM b""",
        "topic_vectors",
    )
)
def embedding_topics(v):
    return topics.embedding_topics(v.embeddings.select("vec_id", "embedding"), v.topic_vectors)


@query(
    """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN concat('/B/', source)
  ELSE concat('/A/', lang) END AS most_confident,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('/B/', source) END AS last
FROM documents"""
)
def chosen_category(v):
    entry = lambda name, confidence: F.struct(name.alias("name"), confidence.alias("confidence"))
    first = entry(F.concat(F.lit("/A/"), "lang"), F.lit(0.5))
    second = entry(
        F.concat(F.lit("/B/"), "source"), F.when(F.col("doc_id") % 3 == 0, 0.75).otherwise(0.25)
    )
    listed = F.when(F.col("doc_id") % 4 != 0, F.array(first, second))
    return v.documents.select(
        "doc_id",
        topics.chosen_category(listed, most_confident=True).alias("most_confident"),
        topics.chosen_category(listed).alias("last"),
    )
