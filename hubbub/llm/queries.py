"""Registered queries of the operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubbub.llm import (
    bpe,
    chat,
    decontaminate,
    fingerprints,
    langid,
    minhash,
    phrases,
    quality,
    repair,
    shards,
    topk,
    toxicity,
    warc,
)
from hubbub.llm.common import held_out, shared_folder, table
from hubbub.session import tune

SQL: dict[str, str] = {}
QUALITY_CUT = 0.3
TOXIC_CUT = 0.5


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return minhash.clustered(table(spark, sf_dir, "documents", "doc_id", "text"))


SQL["op1_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (k) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT node, b FROM reach JOIN ways ON a = seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op2_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).drop("text")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.formatted(rows.unionByName(extra), path), path)


SQL["op3_chat_formatting"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|turn|><|text|><|end|>')
        + length(replace(replace(role, '\', '\\'), '<|', '\l'))
        + length(replace(replace(text, '\', '\\'), '<|', '\l'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    out = held_out(F.col("doc_id"))
    found = toxicity.scored(docs, toxicity.fitted(docs, labels, ~out))
    return found.select(
        "doc_id",
        out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_CUT).cast("int").alias("predicted"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    out = held_out(F.col("doc_id"))
    found = quality.scored(docs, quality.fitted(docs, labels, ~out))
    return found.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    path = shared_folder(spark)
    warc.write_archives(pages, path)
    return warc.read_archives(spark, path, dict(pages.dtypes)["page_id"])


SQL["op6_warc"] = """
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
t AS (SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND (page_id IS NULL OR page_id > first) AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN first END AS refers_to
FROM t
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.report(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


SQL["op7_decontamination"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
hits AS (
    SELECT r, i, p.n, item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM places) p
    JOIN windows USING (n, k)),
counted AS (
    SELECT r, count(DISTINCT j) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS s
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (r) LEFT JOIN items USING (r)
"""

def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = fingerprints.compared(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    found = shards.sharded(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fitted(docs.where(~held_out(F.col("doc_id"))))
    found = langid.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return phrases.collocations(table(spark, sf_dir, "documents", "text", "lang"))


SQL["op11_phrase_mining"] = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
    SELECT lang, 1 AS m, unnest(w) AS phrase FROM w
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))) FROM w
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) FROM w),
f AS (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE m >= 2 AND f >= 10),
cut AS (
    SELECT lang, phrase, m, a, 1 AS k, p[1] AS lhs, array_to_string(p[2:], ' ') AS rhs FROM often
    UNION ALL SELECT lang, phrase, m, a, 2, array_to_string(p[1:2], ' '), p[3] FROM often WHERE m = 3),
scored AS (
    SELECT cut.lang, cut.phrase, cut.m, a, k, l.f AS l, r.f AS r,
        (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
    FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lhs
    JOIN f r ON r.lang = cut.lang AND r.phrase = rhs),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, part, max(a) AS a FROM (
        SELECT DISTINCT lang, phrase, a, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS part
        FROM often WHERE m = 3)
    GROUP BY lang, part),
kept AS (
    SELECT x.* FROM lowest x LEFT JOIN longer y ON y.lang = x.lang AND y.part = x.phrase
    WHERE y.a IS NULL OR 100 * y.a < 50 * x.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_inner_products(vectors, F.col("vec_id") % 50 == 0)


SQL["op12_top_products"] = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.row AS q, q.vec_id AS query_id, c.vec_id, c.row,
        CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.row <> c.row)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, row) AS rank FROM s)
WHERE rank <= 5
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repaired(repair.damaged(rows))


def _edited(state: str, cost: str, letters: str, piece: str) -> str:
    """A DP state after an edit: its cost, audit and repaired rows, null where it cannot be reached."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}', 'r': {state}.r || {piece}}} END"


def _after_row(to: int, letter: str | None, before: tuple[int, ...]) -> str:
    """The best state ``to`` after a row: deleted, or kept or reroled as ``letter`` in a state of ``before``."""
    ways = [_edited(f"t{to}", "4", "D", "''")]
    name = {"u": "'user'", "a": "'assistant'", "s": "role"}.get(letter)
    for b in before:
        keep = _edited(f"t{b}", "extra", "K", "chr(10) || role || ':' || text")
        ways.append(f"CASE WHEN fault NOT IN (1, 2) AND initial = '{letter}' THEN {keep} END")
        if letter != "s":
            rerole = _edited(f"t{b}", "3 + extra", "R", f"chr(10) || {name} || ':' || text")
            ways.append(f"CASE WHEN fault NOT IN (1, 2) AND initial <> '{letter}' THEN {rerole} END")
    return f"list_min([{', '.join(ways)}])"


_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
#: The grammar as an automaton (start, after s, after u, after a), row by row: no alignment with a target.
SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE bits(n, c, i) AS (
    SELECT n, n, 0 FROM range(256) t(n)
    UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crcs AS (SELECT list(c ORDER BY n) AS crc FROM bits WHERE i = 8),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda x: CAST(ascii(x) AS BIGINT))),
        lambda h, b: xor(crc[1 + (xor(h, b) & 255)], h >> 8))) % 20 AS kind
    FROM conversations, crcs),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END))
    FROM keyed WHERE kind <> 0),
placed AS (
    SELECT *, substr(role, 1, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
    FROM damaged),
faulty AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
        WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 3
        ELSE 0 END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS clashes
    FROM placed),
rows AS (SELECT *, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS extra FROM faulty),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0,
        NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR) AS s1, NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR) AS s2,
        NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR) AS s3
    FROM conversations
    UNION ALL
    SELECT conv_id, i, {_after_row(0, None, ())}, {_after_row(1, "s", (0,))},
        {_after_row(2, "u", (0, 1, 3))}, {_after_row(3, "a", (2,))}
    FROM (
        SELECT w.conv_id, r.i, r.role, r.text, r.initial, r.fault, r.extra, s0 AS t0, s1 AS t1,
            list_min([s2, {_edited("s0", "3", "I", _USER)}, {_edited("s1", "3", "I", _USER)}, {_edited("s3", "3", "I", _USER)}]) AS t2,
            list_min([s3, {_edited("s2", "3", "I", _ASSISTANT)},
                {_edited("s0", "6", "II", f"{_USER} || {_ASSISTANT}")}, {_edited("s1", "6", "II", f"{_USER} || {_ASSISTANT}")}]) AS t3
        FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)),
ends AS (
    SELECT conv_id, list_min([s0, {_edited("s1", "6", "II", f"{_USER} || {_ASSISTANT}")}, {_edited("s2", "3", "I", _ASSISTANT)}, s3]) AS best
    FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
        count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (clashes) AS illegal
    FROM rows GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(SQL)
