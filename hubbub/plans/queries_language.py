"""Registered queries: the trained language tag."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubbub.functions.text import THAI
from hubbub.operators import language
from hubbub.plans.registry import query
from hubbub.session import saved

_COUNTS = r"""
w AS (
  SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents),
g AS (
  SELECT doc_id, lang, word, unnest(list_transform(range(1, length(word) + 1),
    lambda i: substring(' ' || word || ' ', i, 3))) AS gram
  FROM w),
counts AS (
  SELECT lang AS language, gram, count(*) AS count FROM g
  WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY lang, gram),
totals AS (SELECT language, sum(count) AS total FROM counts GROUP BY language),
grams AS (SELECT DISTINCT gram FROM counts),
weights AS (
  SELECT gram, language, CAST(round(ln((coalesce(count, 0) + 1)
    / CAST(total + (SELECT count(*) FROM grams) AS DOUBLE)) * 1000) AS BIGINT) AS weight
  FROM grams CROSS JOIN totals LEFT JOIN counts USING (gram, language))"""


def _weights(v):
    train = v.documents.where(F.col("doc_id") % 5 != 0)
    return language.trigram_weights(saved(language.trigram_counts(train, "text", "lang")))


@query(f"WITH {_COUNTS} SELECT gram, language, weight FROM weights")
def language_weights(v):
    weights, languages = _weights(v)
    names = F.array(*[F.lit(x) for x in languages])
    pairs = F.arrays_zip(names.alias("language"), F.col("weights").alias("weight"))
    return weights.select("gram", F.explode(pairs).alias("p")).select("gram", "p.*")


@query(
    f"""
WITH {_COUNTS},
scores AS (SELECT doc_id, language, sum(weight) AS score FROM g JOIN weights USING (gram) GROUP BY ALL),
best AS (
  SELECT doc_id, language FROM scores
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language) = 1)
SELECT d.doc_id, CASE WHEN regexp_matches(text, '{THAI}') THEN 'th' ELSE coalesce(b.language, 'n/a') END AS language
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id"""
)
def trained_language_tag(v):
    weights, languages = _weights(v)
    return language.trained_language_tags(v.documents, saved(weights), languages, "doc_id", "text")
