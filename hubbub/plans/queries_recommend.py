"""Registered queries: training sets, models, rankings, recommendations, clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.functions.constants import CONTENT_FEATURES
from hubbub.operators import clusters, engagement, features, models, ordering, recommend, stats
from hubbub.plans.queries_stats import age
from hubbub.plans.registry import query, rows_query
from hubbub.plans.sample_views import AS_OF, duckdb_sql
from hubbub.session import saved

_KINDS = ("like", "comment", "recast", "quote")
_COUNT_KINDS = ", ".join(f"count(*) FILTER (type = '{k}') AS \"{k}\"" for k in _KINDS)

_COUNTRY = f"""
ce AS (
  SELECT e.content_id, lower(a.country_code) AS country_code, {_COUNT_KINDS}
  FROM fx_engagements e JOIN fx_users u ON e.user_id = u.user_id
  JOIN fx_accounts a ON u.owner_account = a.account_id
  WHERE e.updated_at >= @t0 - INTERVAL 30 DAY GROUP BY e.content_id, lower(a.country_code))"""
_ACCOUNT = f"""
ae AS (
  SELECT u.owner_account AS account_id, e.content_id, {_COUNT_KINDS},
    count(*) FILTER (type IN ('like', 'comment', 'recast', 'quote')) AS engagements
  FROM fx_engagements e JOIN fx_users u ON e.user_id = u.user_id
  GROUP BY u.owner_account, e.content_id)"""
_FEATURES = f"""
cs AS (
  SELECT content_id, author_id, like_count, comment_count, recast_count, quote_count,
    CAST(coalesce(len(photos), 0) AS INTEGER) AS photo_count,
    CAST(length(coalesce(message, '-')) AS INTEGER) AS character_length, {age('updated_at')} AS age_score
  FROM fx_contents WHERE created_at >= @t0 - INTERVAL 30 DAY AND visibility = 'publish'),
cr AS (
  SELECT author_id, count(*) AS n, sum(coalesce(like_count, 0)) AS l, sum(comment_count) AS c,
    sum(recast_count) AS r, sum(quote_count) AS q
  FROM fx_contents JOIN fx_users w ON author_id = w.user_id AND w.visibility = 'publish'
  JOIN fx_accounts p ON w.owner_account = p.account_id
  WHERE updated_at >= @t0 - INTERVAL 30 DAY AND fx_contents.visibility = 'publish'
  GROUP BY author_id),
cf AS (
  SELECT content_id, coalesce(like_count, 0) AS like_count, comment_count, recast_count,
    quote_count, photo_count, character_length, coalesce(n, 0) AS creator_content_count,
    CAST(coalesce(l, 0) AS BIGINT) AS creator_liked_count,
    CAST(coalesce(c, 0) AS BIGINT) AS creator_commented_count,
    CAST(coalesce(r, 0) AS BIGINT) AS creator_recasted_count,
    CAST(coalesce(q, 0) AS BIGINT) AS creator_quoted_count, age_score
  FROM cs LEFT JOIN cr ON cs.author_id = cr.author_id)"""
_ALL = ("contents", "users", "accounts", "engagements")


def _country_rows(v):
    return features.country_engagement(v.engagements, v.users, v.accounts, AS_OF)


def _content_features(v):
    content = stats.content_stats(v.contents, AS_OF)
    creators = stats.creator_stats(v.contents, v.users, v.accounts, AS_OF)
    return features.content_features(content, creators)


@query(duckdb_sql(f"WITH {_COUNTRY} SELECT * FROM ce", *_ALL[1:]))
def country_engagement(v):
    return _country_rows(v)


@query(duckdb_sql(f"WITH {_ACCOUNT} SELECT * FROM ae", "users", "engagements"))
def account_engagement(v):
    return features.account_engagement(v.engagements, v.users)


_FIRST_KINDS = ", ".join(f"CAST(type = '{k}' AS BIGINT) AS \"{k}\"" for k in _KINDS)


@query(
    duckdb_sql(
        f"""
WITH f AS (
  SELECT u.owner_account AS account_id, e.content_id, e.type,
    row_number() OVER (PARTITION BY u.owner_account, e.content_id
      ORDER BY e.created_at, e.id) AS place
  FROM fx_engagements e JOIN fx_users u ON e.user_id = u.user_id)
SELECT account_id, content_id, {_FIRST_KINDS}, CAST(type <> 'report' AS BIGINT) AS engagements
FROM f WHERE place = 1""",
        "users",
        "engagements",
    )
)
def account_engagement_as_coded(v):
    return features.account_engagement(v.engagements, v.users, as_coded=True)


@query(
    duckdb_sql(
        f"WITH {_FEATURES} SELECT * REPLACE (round(age_score, 6) AS age_score) FROM cf", *_ALL
    )
)
def content_features(v):
    return _content_features(v)


def _label_sql(cte: str, table: str, key: str) -> str:
    n = {k: f"CASE WHEN \"n_{k}\" = 0 THEN 1 ELSE \"n_{k}\" END" for k in _KINDS}
    total = " + ".join(n.values())
    label = " + ".join(f"x.\"{k}\" * (1 - ({n[k]}) / ({total}))" for k in _KINDS)
    sums = ", ".join(f"sum(\"{k}\") AS \"n_{k}\"" for k in _KINDS)
    extra = ", engagements" if table == "ae" else ""
    return f"""
WITH {cte}, w AS (SELECT {key}, {sums} FROM {table} GROUP BY {key}),
labelled AS (
  SELECT x.content_id, x.{key}, "like", comment, recast, quote{extra}, {label} AS label
  FROM {table} x JOIN w ON x.{key} = w.{key})"""


_COUNTRY_LABEL = _label_sql(_COUNTRY, "ce", "country_code")


@query(
    duckdb_sql(
        _COUNTRY_LABEL + " SELECT * REPLACE (round(label, 6) AS label) FROM labelled", *_ALL[1:]
    )
)
def country_labels(v):
    return features.weighted_label(saved(_country_rows(v)), "country_code")


@query(
    duckdb_sql(
        _label_sql(_ACCOUNT, "ae", "account_id")
        + " SELECT * REPLACE (round(label, 6) AS label) FROM labelled",
        "users",
        "engagements",
    )
)
def account_labels(v):
    rows = saved(features.account_engagement(v.engagements, v.users))
    return features.weighted_label(rows, "account_id")


@query(
    duckdb_sql(
        f"""WITH {_COUNTRY}
SELECT country_code, count(*) AS rows FROM ce GROUP BY country_code HAVING count(*) > 2""",
        *_ALL[1:],
    )
)
def eligible_countries(v):
    return features.eligible_keys(_country_rows(v), "country_code", 3)


@query(
    duckdb_sql(
        f"""WITH {_ACCOUNT}
SELECT account_id, count(*) AS rows FROM ae WHERE engagements = 1
GROUP BY account_id HAVING count(*) > 2""",
        "users",
        "engagements",
    )
)
def eligible_accounts(v):
    return features.eligible_accounts(features.account_engagement(v.engagements, v.users))


def _country_training(v):
    rows = saved(_country_rows(v))
    trainable = features.eligible_keys(rows, "country_code", 3).select("country_code")
    labelled = features.weighted_label(
        rows.join(trainable, "country_code", "left_semi"), "country_code"
    )
    return features.with_features(labelled, _content_features(v))


_TRAINING = (
    _COUNTRY_LABEL
    + f""",
{_FEATURES},
tr AS (
  SELECT l.*, {', '.join(f'coalesce(cf.{c}, 0) AS {c}' for c in CONTENT_FEATURES)}
  FROM labelled l LEFT JOIN cf ON l.content_id = cf.content_id
  WHERE country_code IN (SELECT country_code FROM ce GROUP BY 1 HAVING count(*) > 2))"""
)


@query(
    duckdb_sql(
        _TRAINING
        + """
SELECT * REPLACE (round(label, 6) AS label, round(age_score, 6) AS age_score) FROM tr""",
        *_ALL,
    )
)
def country_training_set(v):
    return _country_training(v)


@query(
    duckdb_sql(
        _TRAINING
        + """,
m AS (
  SELECT country_code, count(*) AS rows, avg(comment_count) AS m1, avg(character_length) AS m2,
    avg(label) AS my, sqrt(var_pop(comment_count)) AS s1, sqrt(var_pop(character_length)) AS s2,
    covar_pop(comment_count, character_length) AS c12, covar_pop(comment_count, label) AS c1,
    covar_pop(character_length, label) AS c2
  FROM tr GROUP BY country_code),
b AS (
  SELECT *, c12 / (s1 * s2) AS r, c1 / s1 AS d1, c2 / s2 AS d2 FROM m),
k AS (
  SELECT *, (1.1 * d1 - r * d2) / (1.21 - r * r) / s1 AS k1,
    (1.1 * d2 - r * d1) / (1.21 - r * r) / s2 AS k2 FROM b)
SELECT country_code AS account, 'ridge' AS model, rows, @t0 AS trained_at,
  round(my - k1 * m1 - k2 * m2, 6) + 0.0 AS intercept,
  round(k1, 6) + 0.0 AS first_coefficient, round(k2 * 1000, 6) + 0.0 AS second_coefficient_1000
FROM k""",
        *_ALL,
    )
)
def country_models_two_features(v):
    fitted = models.fit_per_key(
        _country_training(v), "country_code", ["comment_count", "character_length"], "label", AS_OF
    )
    return fitted.select(
        "account",
        "model",
        "rows",
        "trained_at",
        "intercept",
        F.get("coefficients", F.lit(0)).alias("first_coefficient"),
        (F.get("coefficients", F.lit(1)) * 1000).alias("second_coefficient_1000"),
    )


def _country_models(v):
    return models.fit_per_key(
        _country_training(v), "country_code", CONTENT_FEATURES, "label", AS_OF
    )


def _checked_models(fitted, training, key):
    """Keys, rows and how far the coefficients are from solving the normal equations."""
    return models.normal_residuals(fitted, training, key, CONTENT_FEATURES, "label").select(
        "account", "model", "rows", F.round("residual", 6).alias("residual")
    )


@query(
    duckdb_sql(
        _TRAINING
        + """
SELECT country_code AS account, 'ridge' AS model, count(*) AS rows, CAST(0 AS DOUBLE) AS residual
FROM tr GROUP BY country_code""",
        *_ALL,
    )
)
def country_models(v):
    training = saved(_country_training(v))
    fitted = models.fit_per_key(training, "country_code", CONTENT_FEATURES, "label", AS_OF)
    return _checked_models(fitted, training, "country_code")


@rows_query
def country_model_rows(v):
    """Intercept and coefficients of each model, beside the residual of its normal equations."""
    training = saved(_country_training(v))
    fitted = models.fit_per_key(training, "country_code", CONTENT_FEATURES, "label", AS_OF)
    return models.normal_residuals(fitted, training, "country_code", CONTENT_FEATURES, "label")


@query(
    duckdb_sql(
        f"""
WITH {_ACCOUNT},
t AS (SELECT account_id FROM ae WHERE engagements = 1 GROUP BY account_id HAVING count(*) > 2)
SELECT account_id AS account, 'ridge' AS model, count(*) AS rows, CAST(0 AS DOUBLE) AS residual
FROM ae WHERE account_id IN (SELECT account_id FROM t) GROUP BY account_id""",
        "engagements",
        "users",
    )
)
def account_models(v):
    training = _account_training(v)
    fitted = models.fit_per_key(training, "account_id", CONTENT_FEATURES, "label", AS_OF)
    return _checked_models(fitted, training, "account_id")


@rows_query
def account_model_rows(v):
    """Intercept and coefficients of each model, beside the residual of its normal equations."""
    training = _account_training(v)
    fitted = models.fit_per_key(training, "account_id", CONTENT_FEATURES, "label", AS_OF)
    return models.normal_residuals(fitted, training, "account_id", CONTENT_FEATURES, "label")


def _account_training(v):
    rows = saved(features.account_engagement(v.engagements, v.users))
    trainable = features.eligible_accounts(rows).select("account_id")
    labelled = features.weighted_label(
        rows.join(trainable, "account_id", "left_semi"), "account_id"
    )
    return saved(features.with_features(labelled, _content_features(v)))


_TRAINED = f"""
WITH {_COUNTRY},
m AS (SELECT country_code AS account, count(*) AS rows FROM ce GROUP BY 1 HAVING count(*) > 2),
k AS (
  SELECT DISTINCT concat('c', CAST(c_nationkey AS STRING)) AS account FROM customer
  UNION SELECT DISTINCT concat('x', CAST(n_nationkey AS STRING)) FROM nation)
SELECT account, rows FROM m UNION ALL
SELECT k.account, m.rows FROM k, m
WHERE m.account = 'c3' AND k.account NOT IN (SELECT account FROM m)"""


@query(duckdb_sql(_TRAINED, *_ALL[1:]))
def base_model_fallback(v):
    eligible = features.eligible_keys(_country_rows(v), "country_code", 3)
    trained = saved(eligible.withColumnRenamed("country_code", "account"))
    keys = v.customer.select(
        F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("account")
    ).union(v.nation.select(F.concat(F.lit("x"), F.col("n_nationkey").cast("string"))))
    return models.base_model_fallback(trained, keys, base="c3")


_ARTICLES = """
ar AS (
  SELECT c.content_id, c.author_id AS author, c.type AS content_type, c.created_at,
    c.message AS title, coalesce(p.country_code, 'us') AS country_code,
    coalesce(p.continent_code, 'us') AS continent_code, coalesce(f.language, 'en') AS language,
    coalesce(f.class, 'etc') AS class
  FROM fx_contents c JOIN fx_filtering f ON c.content_id = f.content_id
  LEFT JOIN fx_users u ON c.author_id = u.user_id
  LEFT JOIN fx_accounts p ON u.owner_account = p.account_id
  WHERE c.visibility = 'publish' AND c.message IS NOT NULL)"""
_PAIRS = f"""{_ARTICLES},
pr AS (
  SELECT user_id AS person_id, content_id, max(created_at) AS timestamp,
    sum(CASE type WHEN 'comment' THEN 1.5 WHEN 'like' THEN 1.0 WHEN 'quote' THEN 2.5
      ELSE 2.0 END)::DOUBLE AS event_strength
  FROM fx_engagements WHERE created_at >= @t0 - INTERVAL 4 MONTH AND type <> 'report'
    AND content_id IN (SELECT content_id FROM ar)
  GROUP BY user_id, content_id)"""
_FREQUENT = f"""{_PAIRS},
fr AS (
  SELECT * FROM pr WHERE person_id IN (
    SELECT person_id FROM pr GROUP BY person_id HAVING count(*) >= 4))"""
_REC = ("contents", "users", "accounts", "filtering", "engagements")


def _articles(v):
    return recommend.articles(v.contents, v.users, v.accounts, v.filtering)


def _listed(v):
    return recommend.listed_contents(v.contents, v.filtering)


def _pairs(v):
    return recommend.interactions(v.engagements, _listed(v), AS_OF)


@query(duckdb_sql(f"WITH {_ARTICLES} SELECT * FROM ar", *_REC[:4]))
def articles(v):
    return _articles(v)


@query(duckdb_sql(f"WITH {_PAIRS} SELECT * FROM pr", *_REC))
def interactions(v):
    return _pairs(v)


@query(duckdb_sql(f"WITH {_FREQUENT} SELECT * FROM fr", *_REC))
def min_interaction_users(v):
    return recommend.min_interaction_users(_pairs(v))


def _popularity_sql(by: str) -> str:
    return duckdb_sql(
        f"""
WITH {_FREQUENT},
g AS (
  SELECT fr.content_id, title, {by}, max(author) AS author, max(timestamp) AS timestamp,
    sum(event_strength) AS event_strength
  FROM fr JOIN ar ON fr.content_id = ar.content_id GROUP BY fr.content_id, title, {by})
SELECT *, round(coalesce((event_strength - (SELECT min(event_strength) FROM g))
  / nullif((SELECT max(event_strength) - min(event_strength) FROM g), 0), 0), 6) AS score
FROM g""",
        *_REC,
    )


@query(
    duckdb_sql(
        f"""
WITH {_PAIRS},
m AS (
  SELECT content_id, max(event_strength) AS most, CASE WHEN count(*) = (
      SELECT count(DISTINCT person_id) FROM pr) THEN min(event_strength) ELSE 0 END AS low
  FROM pr GROUP BY content_id)
SELECT pr.*, round(coalesce((event_strength - low) / nullif(most - low, 0), 0), 6) AS scaled
FROM pr JOIN m ON pr.content_id = m.content_id""",
        *_REC,
    )
)
def scaled_strength(v):
    return recommend.scaled_strength(saved(_pairs(v)))


def _strength(v):
    frequent = recommend.min_interaction_users(saved(_pairs(v)))
    return saved(recommend.content_strength(frequent, _articles(v)))


@query(_popularity_sql("country_code"))
def popularity_by_country(v):
    return recommend.popularity(_strength(v), "country_code")


@query(_popularity_sql("language"))
def popularity_by_language(v):
    return recommend.popularity(_strength(v), "language")


def _ranking(by: str, place: int) -> str:
    return f"""
  SELECT fr.content_id, title, max(timestamp) AS timestamp, sum(event_strength) AS event_strength,
    max(author) AS author, '{by}' AS model_key, {by} AS model_value, {place} AS list_order
  FROM fr JOIN ar ON fr.content_id = ar.content_id GROUP BY fr.content_id, title, {by}"""


@query(
    duckdb_sql(
        f"""
WITH {_FREQUENT},
u AS ({_ranking('country_code', 0)} UNION ALL {_ranking('language', 1)}),
s AS (
  SELECT *, round_even((event_strength - min(event_strength) OVER (PARTITION BY list_order))
      / (max(event_strength) OVER (PARTITION BY list_order)
         - min(event_strength) OVER (PARTITION BY list_order)), 4) AS score,
    row_number() OVER (PARTITION BY content_id
      ORDER BY list_order, event_strength DESC, model_value) AS place FROM u)
SELECT * EXCLUDE (list_order, place) FROM s WHERE place = 1""",
        *_REC,
    )
)
def default_feed(v):
    return recommend.default_feed(_strength(v))


@query(
    duckdb_sql(
        f"""
WITH {_PAIRS}
SELECT *, CASE WHEN hour(timestamp) > 6 AND hour(timestamp) < 20 THEN 1 ELSE 0 END AS daytime,
  CASE WHEN dayofweek(timestamp) IN (0, 6) THEN 1 ELSE 0 END AS weekend FROM pr""",
        *_REC,
    )
)
def session_features(v):
    pairs = recommend.interactions(v.engagements, _listed(v), AS_OF, unknown_as="like")
    return recommend.session_features(pairs)


@query(
    duckdb_sql(
        f"""
WITH {_PAIRS}, d AS (SELECT DISTINCT person_id FROM pr)
SELECT person_id, row_number() OVER (ORDER BY md5(CAST(person_id AS VARCHAR))) - 1 AS "user"
FROM d""",
        *_REC,
    )
)
def person_dictionary(v):
    return ordering.dense_ids(saved(_pairs(v)), "person_id", "user")


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
def member_recommendations(v):
    """Scores have no SQL form; that each is the product of its two factors, row by row, does."""
    persons, contents, people, items = recommend.fit_factors(saved(_pairs(v)))
    persons, contents = saved(persons), saved(contents)
    scores = recommend.best_contents(persons, contents, 10)
    checked = recommend.checked_scores(scores, persons, contents)
    named = checked.join(people, "user").join(items, "content", "left")
    once = F.count(F.lit(1)).over(Window.partitionBy("user", "content")) == 1
    return named.select(
        "person_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("content_id").isNotNull().alias("known_content"),
        F.col("is_product").alias("score_is_product"),
        once.alias("content_once"),
    )


@rows_query
def member_recommendation_rows(v):
    """The best contents of each person, with their scores."""
    scores, people, items = recommend.member_recommendations(saved(_pairs(v)), k=10)
    return scores.join(people, "user").join(items, "content").select("person_id", "content_id", "score")


def _topic_counts(v):
    return engagement.user_topic_engagement(v.engagements, v.contentinfo)


def _taxonomy(v):
    return v.contentinfo.select(F.explode("topics").alias("topic_id"))


@query(
    duckdb_sql(
        """
WITH n AS (
  SELECT user_id, type, topic_id, count(*) AS count FROM (
    SELECT e.user_id, e.type, unnest(i.topics) AS topic_id
    FROM fx_engagements e JOIN fx_contentinfo i ON e.content_id = i.content_id
    WHERE e.target_ref = 'content')
  GROUP BY user_id, type, topic_id),
t AS (SELECT DISTINCT unnest(topics) AS topic_id FROM fx_contentinfo),
k AS (SELECT unnest(['comment', 'like', 'quote', 'recast', 'report']) AS type)
SELECT u.user_id, concat(k.type, '.', t.topic_id) AS cell, coalesce(n.count, 0) AS count
FROM (SELECT DISTINCT user_id FROM n) u CROSS JOIN k CROSS JOIN t
LEFT JOIN n ON n.user_id = u.user_id AND n.type = k.type AND n.topic_id = t.topic_id""",
        "engagements",
        "contentinfo",
    )
)
def user_topic_matrix(v):
    counts = _topic_counts(v)
    places = clusters.topic_places(counts, _taxonomy(v))
    return clusters.user_topic_matrix(clusters.user_topic_vectors(counts, places), places)


@query(
    duckdb_sql(
        """
SELECT DISTINCT e.user_id, 'kmeans' AS model, @t0 AS predicted_at, TRUE AS labelled,
  TRUE AS nearest_centroid
FROM fx_engagements e JOIN fx_contentinfo i ON e.content_id = i.content_id
WHERE e.target_ref = 'content' AND len(i.topics) > 0""",
        "engagements",
        "contentinfo",
    )
)
def user_clusters(v):
    """Which cluster a user falls in has no SQL form; that its centroid is the nearest does."""
    counts = saved(_topic_counts(v))
    places = clusters.topic_places(counts, _taxonomy(v))
    vectors = saved(clusters.user_topic_vectors(counts, places))
    fitted = clusters.fit_clusters(vectors, k=7)
    labels = clusters.labelled_users(fitted, vectors, AS_OF)
    checked = clusters.with_distances(labels, vectors, fitted)
    return checked.select(
        "user_id",
        "model",
        "predicted_at",
        F.col("user_class").between(0, 6).alias("labelled"),
        (F.col("own_distance") <= F.col("least_distance") + 1e-9 * (1 + F.col("least_distance"))).alias("nearest_centroid"),
    )


@rows_query
def user_cluster_rows(v):
    """The cluster of each user."""
    counts = saved(_topic_counts(v))
    places = clusters.topic_places(counts, _taxonomy(v))
    return clusters.user_clusters(clusters.user_topic_vectors(counts, places), AS_OF, k=7)
