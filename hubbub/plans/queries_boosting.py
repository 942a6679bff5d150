"""Registered queries: boosted trees per country."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubbub.functions.constants import CONTENT_FEATURES
from hubbub.operators import boosting
from hubbub.plans.queries_recommend import _ALL, _TRAINING, _country_training
from hubbub.plans.registry import query, rows_query
from hubbub.plans.sample_views import duckdb_sql
from hubbub.session import saved

_BINS = 16

#: The base and the first split of each country's first tree, by all cuts of all features.
_STUMPS = (
    _TRAINING
    + f""",
t AS (
  SELECT country_code AS k, CAST(label AS DOUBLE) AS y,
    [{', '.join(f'CAST({c} AS DOUBLE)' for c in CONTENT_FEATURES)}] AS x
  FROM tr WHERE country_code IS NOT NULL AND label IS NOT NULL),
base AS (SELECT k, avg(y) AS base, count(*) AS n FROM t GROUP BY k),
long AS (
  SELECT t.k, y - base AS r, f, x[f + 1] AS v
  FROM t JOIN base ON t.k = base.k, (SELECT unnest(range({len(CONTENT_FEATURES)})) AS f)),
cuts AS (
  SELECT k, f, list_sort(list_distinct(list_transform(range(1, {_BINS}),
    lambda i: s[greatest(1, (i * len(s) + {_BINS - 1}) // {_BINS})]))) AS cuts
  FROM (SELECT k, f, list_sort(list(v)) AS s FROM long WHERE v IS NOT NULL GROUP BY k, f)),
hist AS (
  SELECT l.k, l.f, len(list_filter(cuts, lambda c: c < v)) AS b, sum(r) AS r, count(*) AS n
  FROM long l JOIN cuts c ON l.k = c.k AND l.f = c.f GROUP BY ALL),
run AS (
  SELECT *, sum(r) OVER w AS lr, sum(n) OVER w AS ln, sum(r) OVER (PARTITION BY k, f) AS tr,
    sum(n) OVER (PARTITION BY k, f) AS tn
  FROM hist WINDOW w AS (PARTITION BY k, f ORDER BY b)),
gains AS (
  SELECT *, round(lr * lr / (ln + 1) + (tr - lr) * (tr - lr) / (tn - ln + 1) - tr * tr / (tn + 1), 6) AS gain
  FROM run WHERE tn > ln),
best AS (
  SELECT g.*, cuts[b + 1] AS cut FROM gains g JOIN cuts c ON g.k = c.k AND g.f = c.f
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY g.k ORDER BY gain DESC, g.f, b) = 1)
SELECT k AS country_code, 0 AS tree, 0 AS node, CAST(NULL AS INTEGER) AS feature, CAST(NULL AS DOUBLE) AS threshold,
  round(base, 6) + 0.0 AS value, n AS rows FROM base
UNION ALL SELECT k, 1, 0, CAST(f AS INTEGER), round(cut, 6), NULL, CAST(tn AS BIGINT) FROM best
UNION ALL SELECT k, 1, 1, NULL, NULL, round(0.3 * lr / (ln + 1), 6) + 0.0, CAST(ln AS BIGINT) FROM best
UNION ALL SELECT k, 1, 2, NULL, NULL, round(0.3 * (tr - lr) / (tn - ln + 1), 6) + 0.0, CAST(tn - ln AS BIGINT) FROM best"""
)


def _trees(v, **setting):
    training = saved(_country_training(v))
    return boosting.fit_boosted(training, "country_code", CONTENT_FEATURES, "label", bins=_BINS, **setting)


@query(duckdb_sql(_STUMPS, *_ALL))
def country_tree_stumps(v):
    """One tree of one split per country."""
    return _trees(v, trees=1, depth=1).drop("gain")


@rows_query
def country_tree_rows(v):
    """Trees of every country, node by node."""
    return _trees(v, trees=5, depth=3)


@rows_query
def country_tree_predictions(v):
    """Training rows with what the trees of their country make of them, beside their label."""
    training = saved(_country_training(v))
    trees = boosting.fit_boosted(training, "country_code", CONTENT_FEATURES, "label", trees=5, depth=3, bins=_BINS)
    scored = boosting.predict_boosted(training, saved(trees), "country_code", CONTENT_FEATURES, depth=3)
    return scored.select("country_code", "content_id", F.col("label").cast("double").alias("label"), "predicted")
