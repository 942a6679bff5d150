"""Registered queries: text vectors, topics from text alone, and the autoencoder's recommendations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.operators import autoencoder, recommend, topics, vectors
from hubbub.plans.queries_recommend import _PAIRS, _REC, _pairs
from hubbub.plans.registry import query, rows_query
from hubbub.plans.sample_views import duckdb_sql
from hubbub.session import saved

_RANK, _CELLS = 16, 1024


@query(
    r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),
g AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram
  FROM w)
SELECT doc_id, gram, count(*) AS count FROM g GROUP BY doc_id, gram"""
)
def message_ngrams(v):
    return vectors.ngram_counts(v.documents.select("doc_id", "text"), "doc_id", "text")


def _fitted(v):
    counts = saved(vectors.bucket_counts(v.documents.select("doc_id", "text"), "doc_id", "text"))
    return counts, saved(vectors.fit_vectors(counts, _RANK))


@query(
    r"""
SELECT doc_id, regexp_matches(coalesce(text, ''), '\p{L}') AS has_vector, TRUE AS unit_length, TRUE AS is_projection
FROM documents"""
)
def text_vectors(v):
    """Vectors have no SQL form; that each is the projection of the text's weights, of length 1, does."""
    counts, model = _fitted(v)
    found = vectors.text_vectors(v.documents.select("doc_id", "text"), model, "doc_id", "text")
    weight = (1 + F.log("e.count")) * F.col("rarity")
    # The model has one row per bucket at any number of texts: entries meet it where they are read.
    exploded = counts.select("doc_id", F.explode("entries").alias("e"))
    entries = exploded.join(F.broadcast(model), F.col("e.bucket") == F.col("bucket"))
    sums = [F.sum(weight * F.get("loadings", F.lit(i))).alias(f"s{i}") for i in range(_RANK)]
    own = entries.groupBy("doc_id").agg(F.array(*sums).alias("own"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    joined = found.join(own, "doc_id", "left")
    length = F.sqrt(dot("own", "own"))
    apart = F.zip_with("embedding", "own", lambda x, y: F.abs(x - y / length))
    return joined.select(
        "doc_id",
        F.col("embedding").isNotNull().alias("has_vector"),
        F.coalesce(F.abs(dot("embedding", "embedding") - 1) < 1e-9, F.col("own").isNull()).alias("unit_length"),
        F.coalesce(F.array_max(apart) < 1e-6, F.col("own").isNull()).alias("is_projection"),
    )


@rows_query
def text_topic_rows(v):
    """The language and source that each text is most like, from words alone."""
    _, model = _fitted(v)
    named = v.documents.where("text IS NOT NULL").withColumn("topic", F.concat_ws("-", "lang", "source"))
    labels = named.groupBy("topic").agg(F.min_by("text", "doc_id").alias("words"))
    messages = v.documents.select("doc_id", F.col("text").alias("message"))
    return topics.text_topics(messages, saved(labels), model, "doc_id").select("doc_id", "class", "score")


@query(
    duckdb_sql(
        f"""
WITH {_PAIRS}
SELECT person_id, unnest(range(1, least(10, (SELECT count(DISTINCT content_id) FROM pr)) + 1)) AS rank,
  TRUE AS known_content, TRUE AS score_is_product, TRUE AS content_once
FROM (SELECT DISTINCT person_id FROM pr)""",
        *_REC,
    )
)
def autoencoder_recommendations(v):
    """Scores have no SQL form; that each is the product of a person's and a content's vector does."""
    found = autoencoder.autoencoder_factors(saved(_pairs(v)), _CELLS, hidden=16, epochs=5)
    persons, contents = (saved(x) for x in found[:2])
    people, items = found[2:]
    checked = recommend.checked_scores(recommend.best_contents(persons, contents, 10), persons, contents)
    once = F.count(F.lit(1)).over(Window.partitionBy("user", "content")) == 1
    return checked.join(people, "user").join(items, "content", "left").select(
        "person_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("content_id").isNotNull().alias("known_content"),
        F.col("is_product").alias("score_is_product"),
        once.alias("content_once"),
    )


@rows_query
def autoencoder_recommendation_rows(v):
    """The best contents of each person by the autoencoder, with its outputs."""
    scores, people, items = autoencoder.autoencoder_recommendations(saved(_pairs(v)), _CELLS, hidden=16, epochs=5)
    return scores.join(people, "user").join(items, "content").select("person_id", "content_id", "score")
