"""Registered queries: reading behaviour and screening."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubbub.operators import fraud, models
from hubbub.plans.registry import query
from hubbub.plans.sample_views import AS_OF, duckdb_sql
from hubbub.session import saved

_TIMES = """
rt AS (
  SELECT seen_credential, id, seen_at, off_screen_at,
    (epoch_us(off_screen_at) // 1000 - epoch_us(seen_at) // 1000) / 1000.0 AS reading_sec,
    (epoch_us(seen_at) // 1000 - epoch_us(lag(seen_at) OVER (
      PARTITION BY seen_credential ORDER BY seen_at, id)) // 1000) / 1000.0 AS difference_sec
  FROM fx_feeditems
  WHERE seen_credential IS NOT NULL AND seen_at IS NOT NULL AND off_screen_at IS NOT NULL
  QUALIFY reading_sec >= 0 AND difference_sec IS NOT NULL)"""
_LAST = f"""{_TIMES},
ln AS (
  SELECT *, count(*) OVER (PARTITION BY seen_credential) AS kept FROM (
    SELECT *, row_number() OVER (PARTITION BY seen_credential ORDER BY seen_at DESC, id DESC) AS n
    FROM rt) WHERE n <= 40)"""
_ROWS = "seen_credential, id, seen_at, off_screen_at, round(reading_sec, 6) AS reading_sec, round(difference_sec, 6) AS difference_sec"


@query(duckdb_sql(f"WITH {_TIMES} SELECT {_ROWS} FROM rt", "feeditems"))
def reading_times(v):
    return fraud.reading_times(v.feeditems)


@query(duckdb_sql(f"WITH {_LAST} SELECT {_ROWS} FROM ln WHERE kept >= 40", "feeditems"))
def last_n(v):
    return fraud.last_n(fraud.reading_times(v.feeditems), 40, 40)


_FEATURES = f"""{_LAST},
q AS (
  SELECT seen_credential, min(seen_at) AS a, max(seen_at) AS z, count(*) AS n,
    quantile_cont(reading_sec, 0.95) AS rq, quantile_cont(difference_sec, 0.95) AS dq
  FROM ln WHERE kept >= 40 GROUP BY seen_credential),
r AS (
  SELECT seen_credential, abs(skewness(reading_sec)) AS sk, abs(kurtosis(reading_sec)) AS ku,
    stddev_samp(reading_sec) / avg(reading_sec) AS ns
  FROM ln JOIN q USING (seen_credential) WHERE reading_sec <= rq GROUP BY seen_credential),
d AS (
  SELECT seen_credential, stddev_samp(difference_sec) / avg(difference_sec) AS nd
  FROM ln JOIN q USING (seen_credential) WHERE difference_sec <= dq GROUP BY seen_credential)"""


@query(
    duckdb_sql(
        f"""
WITH {_FEATURES}
SELECT seen_credential, a AS first_seen_at, z AS last_seen_at, n AS count,
  round(sk, 6) AS post_reading_time_abs_skew, round(ku, 6) AS post_reading_time_abs_kurt,
  round(ns, 6) AS post_reading_time_norm_std, round(nd, 6) AS post_reading_time_difference_norm_std,
  @t0 AS created_at, @t0 AS updated_at
FROM q JOIN r USING (seen_credential) JOIN d USING (seen_credential)
WHERE sk IS NOT NULL AND ku IS NOT NULL AND ns IS NOT NULL AND nd IS NOT NULL""",
        "feeditems",
    )
)
def credential_features(v):
    rows = fraud.last_n(fraud.reading_times(v.feeditems), 40, 40)
    return fraud.credential_features(rows, AS_OF)


_F = ("post_reading_time_abs_skew", "post_reading_time_abs_kurt", "post_reading_time_norm_std",
      "post_reading_time_difference_norm_std")
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _F)
_DATASET = f"""
ds AS (
  SELECT * FROM fx_credentials WHERE {_COMPLETE} AND verification_status IS NOT NULL
    AND verified_at IS NOT NULL
  ORDER BY verified_at DESC, seen_credential, first_seen_at, last_seen_at LIMIT 10000)"""


@query(duckdb_sql(f"WITH {_DATASET} SELECT * FROM ds", "credentials"))
def one_class_dataset(v):
    return fraud.one_class_dataset(v.credentials)


@query(
    duckdb_sql(
        f"""WITH {_DATASET}
SELECT count(*) FILTER (NOT verification_status) AS bot_rows,
  count(*) FILTER (NOT verification_status) >= 5 AS trainable FROM ds""",
        "credentials",
    )
)
def train_gate(v):
    return fraud.train_gate(fraud.one_class_dataset(v.credentials))


_SPLITS = f"""{_DATASET},
lb AS (SELECT *, CASE WHEN verification_status THEN 1 ELSE 0 END AS label FROM ds),
sp AS (
  SELECT lb.*, fold, row_number() OVER (
      PARTITION BY fold, label ORDER BY md5(concat_ws(':', '0', fold, id)), id) - 1
    < floor(count(*) OVER (PARTITION BY fold, label) * 0.8) AS is_train
  FROM lb CROSS JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold))"""


def _dataset(v):
    return saved(fraud.with_label(fraud.one_class_dataset(v.credentials)))


def _splits(v):
    labelled = _dataset(v)
    return fraud.stratified_splits(labelled, "id")


@query(duckdb_sql(f"WITH {_SPLITS} SELECT id, label, fold, is_train FROM sp", "credentials"))
def stratified_splits(v):
    return _splits(v).select("id", "label", "fold", "is_train")


_INDEX = range(1, 5)
_X = dict(zip(_INDEX, _F))
_PAIR = {(i, j): f"c{min(i, j)}{max(i, j)}" for i in _INDEX for j in _INDEX}
_COVARIANCES = ", ".join(
    f"covar_pop({_X[i]}, {_X[j]}) AS c{i}{j}" for i in _INDEX for j in _INDEX if i <= j
)
_STEP = {i: " + ".join(f"cv.{_PAIR[i, j]} * p.v{j}" for j in _INDEX) for i in _INDEX}
_NORM = "sqrt(" + " + ".join(f"({_STEP[i]}) * ({_STEP[i]})" for i in _INDEX) + ")"
_PROJECTION = " + ".join(f"({_X[i]} - m{i}) * v{i}" for i in _INDEX)
_DISTANCE = (
    "sqrt(" + " + ".join(f"pow({_X[i]} - m{i} - ({_PROJECTION}) * v{i}, 2)" for i in _INDEX) + ")"
)
# The leading component by power iteration, then bounds over the training distances.
_MODEL = f"""
cv AS (
  SELECT fold, {", ".join(f"avg({_X[i]}) AS m{i}" for i in _INDEX)}, {_COVARIANCES}
  FROM bots GROUP BY fold),
p AS (
  SELECT fold, 0 AS step, 0.1::DOUBLE AS v1, 0.9::DOUBLE AS v2, 0.3::DOUBLE AS v3,
    0.2::DOUBLE AS v4 FROM cv
  UNION ALL
  SELECT p.fold, step + 1, {", ".join(f"({_STEP[i]}) / {_NORM}" for i in _INDEX)}
  FROM p JOIN cv ON p.fold = cv.fold WHERE step < 400),
ax AS (SELECT cv.*, v1, v2, v3, v4 FROM cv JOIN p ON cv.fold = p.fold AND step = 400),
bd AS (
  SELECT fold, count(*) AS rows, min(distance) AS low, max(distance) AS high
  FROM (SELECT bots.fold, {_DISTANCE} AS distance FROM bots JOIN ax ON bots.fold = ax.fold)
  GROUP BY fold),
md AS (
  SELECT fold, rows, low - (high - low) * 0.1 AS lower_bound,
    high + (high - low) * 0.1 AS upper_bound FROM bd)"""


@query(
    duckdb_sql(
        f"""
WITH {_DATASET}, bots AS (SELECT *, 0 AS fold FROM ds WHERE NOT verification_status), {_MODEL}
SELECT fold, rows, round(lower_bound, 5) AS lower_bound, round(upper_bound, 5) AS upper_bound
FROM md""",
        "credentials",
        recursive=True,
    ),
    digits=5,
)
def one_class_model(v):
    bots = _dataset(v).where(F.col("label") == 0)
    model = fraud.fit_one_class_pca(bots, AS_OF)
    return model.select("fold", "rows", "lower_bound", "upper_bound")


_PREDICTED = f"""{_SPLITS}, bots AS (SELECT * FROM sp WHERE is_train AND label = 0), {_MODEL},
pd AS (
  SELECT id, sp.fold, label, distance,
    CASE WHEN distance > upper_bound OR distance < lower_bound THEN 1 ELSE 0 END AS predicted
  FROM (SELECT sp.*, {_DISTANCE} AS distance FROM sp JOIN ax ON sp.fold = ax.fold) sp
  JOIN md ON sp.fold = md.fold WHERE NOT is_train)"""


def _predictions(v):
    splits = saved(_splits(v))
    models_by_fold = fraud.fit_one_class_pca(
        splits.where(F.col("is_train") & (F.col("label") == 0)), AS_OF
    )
    return fraud.predict_one_class(splits.where(~F.col("is_train")), models_by_fold)


@query(
    duckdb_sql(
        f"""WITH {_PREDICTED}
SELECT id, fold, label, predicted, round(distance, 5) AS distance FROM pd""",
        "credentials",
        recursive=True,
    ),
    digits=5,
)
def one_class_predictions(v):
    return _predictions(v).select("id", "fold", "label", "predicted", "distance")


def _report_sql() -> str:
    hit = {c: f"count(*) FILTER (label = {c} AND predicted = {c})" for c in (0, 1)}
    support = {c: f"count(*) FILTER (label = {c})" for c in (0, 1)}
    called = {c: f"count(*) FILTER (predicted = {c})" for c in (0, 1)}

    def ratio(top: str, bottom: str) -> str:
        return f"coalesce(({top}) / nullif({bottom}, 0), 0)"

    scores = {"accuracy": ratio("count(*) FILTER (label = predicted)", "count(*)")}
    for c, name in ((0, "bot_class"), (1, "human_class")):
        scores[f"{name}_precision"] = ratio(hit[c], called[c])
        scores[f"{name}_recall"] = ratio(hit[c], support[c])
        scores[f"{name}_f1-score"] = ratio(f"2 * {hit[c]}", f"({called[c]} + {support[c]})")
        scores[f"{name}_support"] = support[c]
    for m in ("precision", "recall", "f1-score"):
        b, h = scores[f"bot_class_{m}"], scores[f"human_class_{m}"]
        scores[f"macro_avg_{m}"] = f"({b} + {h}) / 2"
        scores[f"weighted_avg_{m}"] = f"({b} * {support[0]} + {h} * {support[1]}) / count(*)"
    scores["macro_avg_support"] = scores["weighted_avg_support"] = "count(*)"
    per_fold = ", ".join(f'{sql} AS "{name}"' for name, sql in scores.items())
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round(avg(\"{name}\"), 6) AS value FROM fo" for name in scores
    )
    return duckdb_sql(
        f"WITH {_PREDICTED}, fo AS (SELECT fold, {per_fold} FROM pd GROUP BY fold) {rows}",
        "credentials",
        recursive=True,
    )


@query(_report_sql())
def classification_report(v):
    return fraud.classification_report(_predictions(v))


_NEWEST = f"""
nw AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY seen_credential
      ORDER BY created_at DESC, last_seen_at DESC, first_seen_at DESC) AS place
    FROM fx_credentials WHERE {_COMPLETE}) WHERE place = 1)"""


@query(
    duckdb_sql(
        f"""WITH {_NEWEST}
SELECT * EXCLUDE (place) FROM nw WHERE verification_status IS NULL AND verified_at IS NULL""",
        "credentials",
    )
)
def latest_unverified(v):
    return fraud.latest_unverified(v.credentials)


@query(
    duckdb_sql(
        f"""
WITH {_NEWEST}, {_DATASET}, bots AS (SELECT *, 0 AS fold FROM ds WHERE NOT verification_status),
{_MODEL},
un AS (SELECT * FROM nw WHERE verification_status IS NULL AND verified_at IS NULL),
bo AS (
  SELECT un.* FROM un CROSS JOIN ax CROSS JOIN md
  WHERE {_DISTANCE} BETWEEN lower_bound AND upper_bound),
lv AS (
  SELECT seen_credential, max(verified_at) AS verified_at FROM fx_credentials
  WHERE {_COMPLETE} AND verification_status IS NOT NULL AND verified_at IS NOT NULL GROUP BY 1)
SELECT bo.seen_credential, first_seen_at, last_seen_at, @t0 AS created_at
FROM bo LEFT JOIN lv ON bo.seen_credential = lv.seen_credential
WHERE lv.verified_at IS NULL OR @t0 - lv.verified_at >= INTERVAL 1 HOUR""",
        "credentials",
        recursive=True,
    )
)
def suspicious_users(v):
    bots = _dataset(v).where(F.col("label") == 0)
    model = fraud.fit_one_class_pca(bots, AS_OF)
    predicted = fraud.predict_one_class(fraud.latest_unverified(v.credentials), model)
    return fraud.suspicious_users(predicted, fraud.last_verified(v.credentials), AS_OF)


_KEYS = ("seen_credential", "first_seen_at", "last_seen_at")
_VERIFIED = """
vf AS (SELECT * FROM fx_suspicious WHERE verification_status IS NOT NULL AND verified_at IS NOT NULL)"""
_MATCH = " AND ".join(f"c.{k} = vf.{k}" for k in _KEYS)


@query(
    duckdb_sql(
        f"""
WITH {_VERIFIED}
SELECT c.* REPLACE (
  CASE WHEN vf.id IS NULL THEN c.verification_status ELSE vf.verification_status END
    AS verification_status,
  CASE WHEN vf.id IS NULL THEN c.verified_at ELSE vf.verified_at END AS verified_at,
  CASE WHEN vf.id IS NULL THEN c.updated_at ELSE @t0 END AS updated_at)
FROM fx_credentials c LEFT JOIN vf ON {_MATCH}""",
        "suspicious",
    )
)
def apply_verification(v):
    return fraud.apply_verification(v.credentials, v.suspicious, AS_OF)[0]


@query(
    duckdb_sql(
        f"""
WITH {_VERIFIED}
SELECT s.* FROM fx_suspicious s WHERE NOT EXISTS (
  SELECT 1 FROM vf JOIN fx_credentials c ON {_MATCH} WHERE vf.id = s.id)""",
        "suspicious",
    )
)
def remaining_suspicious(v):
    return fraud.apply_verification(v.credentials, v.suspicious, AS_OF)[1]


@query(
    duckdb_sql(
        """
SELECT id, model, trained_at FROM (
  SELECT id, CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS model, created_at AS trained_at
  FROM fx_engagements)
WHERE model = 'a' ORDER BY trained_at DESC LIMIT 1""",
        "engagements",
    )
)
def latest_artifact(v):
    trained = v.engagements.select(
        "id",
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("model"),
        F.col("created_at").alias("trained_at"),
    )
    return models.latest_artifact(trained, "a")
