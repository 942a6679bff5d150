"""Registered queries: statistics, engagement topics, feed quality, table writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubbub.functions import scores
from hubbub.functions.scores import Weights
from hubbub.functions.times import moment
from hubbub.operators import engagement, feed, stats, upsert
from hubbub.plans.registry import query
from hubbub.plans.sample_views import AS_OF, duckdb_sql
from hubbub.sources.documents import to_documents

AGE = "exp(-ln(2) / 24 * (epoch_us(@t0) // 1000 - epoch_us({0}) // 1000) / 3600000.0)"


def age(column: str) -> str:
    return AGE.replace("{0}", column)


@query(
    duckdb_sql(
        f"SELECT id, round({age('updated_at').replace('/ 24', '/ 240')}, 6) AS age_score "
        "FROM fx_engagements",
        "engagements",
    )
)
def age_score(v):
    now = moment(v.engagements, "updated_at", AS_OF)
    return v.engagements.select("id", scores.age_score(F.col("updated_at"), now, 240).alias("age_score"))


@query(
    duckdb_sql(
        """
SELECT content_id, CAST(coalesce(like_count, 0) * 1.5 + comment_count * 0.5 + recast_count * 2
  + quote_count * 3 AS DOUBLE) AS engagement_score FROM fx_contents""",
        "contents",
    )
)
def engagement_score(v):
    counts = [F.col(f"{k}_count") for k in ("like", "comment", "recast", "quote")]
    score = scores.engagement_score(*counts, Weights(1.5, 0.5, 2, 3))
    return v.contents.select("content_id", score.alias("engagement_score"))


@query(
    duckdb_sql(
        """
SELECT content_id, updated_at FROM fx_contents WHERE updated_at > @t0 - INTERVAL 30 DAY""",
        "contents",
    )
)
def purge_old(v):
    return stats.purge_old(v.contents.select("content_id", "updated_at"), AS_OF, 30)


_CONTENT_STATS = f"""
SELECT content_id, author_id, updated_at, like_count, comment_count, recast_count, quote_count,
  CAST(coalesce(len(photos), 0) AS INTEGER) AS photo_count,
  CAST(length(coalesce(message, '-')) AS INTEGER) AS character_length,
  {age('updated_at')} AS age_score,
  CAST(coalesce(like_count, 0) * {{l}} + comment_count * {{c}} + recast_count * {{r}}
    + quote_count * {{q}} AS DOUBLE) AS engagement_score
FROM fx_contents WHERE created_at >= @t0 - INTERVAL 30 DAY AND visibility = 'publish'"""


def _content_stats_sql(l: float, c: float, r: float, q: float, bias: float) -> str:
    inner = _CONTENT_STATS.format(l=l, c=c, r=r, q=q)
    return duckdb_sql(
        f"""
WITH s AS ({inner})
SELECT * EXCLUDE (age_score, engagement_score), round(age_score, 6) AS age_score,
  round(engagement_score, 6) AS engagement_score,
  round((engagement_score + {bias}) * age_score, 6) AS score FROM s""",
        "contents",
    )


@query(_content_stats_sql(1, 1, 1, 1, 1))
def content_stats(v):
    return stats.content_stats(v.contents, AS_OF)


@query(_content_stats_sql(1, 2.5, 0.5, 4, 2))
def content_stats_weighted(v):
    return stats.content_stats(v.contents, AS_OF, weights=Weights(1, 2.5, 0.5, 4), bias=2)


_CREATOR_CTE = f"""
WITH t AS (
  SELECT author_id, type, count(*) AS n, sum(coalesce(like_count, 0)) AS l, sum(comment_count) AS c,
    sum(recast_count) AS r, sum(quote_count) AS q, max(updated_at) AS u
  FROM fx_contents WHERE updated_at >= @t0 - INTERVAL 30 DAY AND visibility = 'publish'
  GROUP BY author_id, type),
s AS (SELECT *, {age('u')} AS age, @type_eng AS eng FROM t),
a AS (
  SELECT author_id, sum(n) AS n, sum(l) AS l, sum(c) AS c, sum(r) AS r, sum(q) AS q, max(u) AS u,
    max(age) AS age, @all_eng AS eng FROM s GROUP BY author_id),
j AS (
  SELECT a.*, w.*, p.country_code, p.continent_code, w.followed_count * CAST(0.01 AS DOUBLE) AS followed
  FROM a JOIN fx_users w ON a.author_id = w.user_id AND w.visibility = 'publish'
  JOIN fx_accounts p ON w.owner_account = p.account_id)"""
_DOCUMENTED = {"@type_eng": "l + c + r + q + 1", "@all_eng": "sum(l + c + r + q) + 1"}
_CODED = {"@type_eng": "c + r + 2 * q + 1", "@all_eng": "1"}


def _creator_sql(body: str, engagement_sql: dict[str, str]) -> str:
    text = _CREATOR_CTE + body
    for name, value in engagement_sql.items():
        text = text.replace(name, value)
    return duckdb_sql(text, "contents", "users", "accounts")


def _creator_rows(counts: str, bias: str) -> str:
    return f"""
SELECT author_id AS creator_id, owner_account, display_id, created_at AS user_created_at,
  u AS last_content_updated_at, followed_count, follower_count, country_code, continent_code,
  CAST(n AS BIGINT) AS content_count, {counts}, round(age, 6) AS age_score,
  CAST(eng AS DOUBLE) AS engagement_score, round(followed, 6) AS followed_score,
  round(eng / n * age + (followed + {bias}), 6) AS score
FROM j"""


_FULL_COUNTS = """CAST(l AS BIGINT) AS creator_liked_count, CAST(c AS BIGINT) AS creator_commented_count,
  CAST(r AS BIGINT) AS creator_recasted_count, CAST(q AS BIGINT) AS creator_quoted_count"""
_ZERO_COUNTS = """0::BIGINT AS creator_liked_count, 0::BIGINT AS creator_commented_count,
  0::BIGINT AS creator_recasted_count, 0::BIGINT AS creator_quoted_count"""


@query(_creator_sql(_creator_rows(_FULL_COUNTS, "1"), _DOCUMENTED))
def creator_stats(v):
    return stats.creator_stats(v.contents, v.users, v.accounts, AS_OF).drop("summary")


@query(_creator_sql(_creator_rows(_ZERO_COUNTS, "0.01"), _CODED))
def creator_stats_as_coded(v):
    return stats.creator_stats(v.contents, v.users, v.accounts, AS_OF, as_coded=True).drop(
        "summary"
    )


@query(
    _creator_sql(
        """
SELECT j.author_id AS creator_id, s.type, s.n AS type_count, round(s.n / j.n, 6) AS type_weight,
  round(s.age, 6) AS age_score, CAST(s.eng AS DOUBLE) AS engagement_score,
  round(j.followed, 6) AS followed_score, j.u AS last_content_updated_at,
  round(s.n / j.n * ((s.eng + 1) / (j.eng + 1)) * s.age + j.followed, 6) AS score
FROM j JOIN s ON j.author_id = s.author_id""",
        _DOCUMENTED,
    )
)
def creator_type_scores(v):
    return stats.creator_type_scores(stats.creator_stats(v.contents, v.users, v.accounts, AS_OF))


@query(
    _creator_sql(
        """
SELECT j.author_id AS id, owner_account, country_code, CAST(j.n AS BIGINT) AS contents,
  CAST(j.l AS BIGINT) AS liked, round(j.age, 6) AS age, round(j.followed, 6) AS followed, s.type,
  s.n AS type_count, CAST(s.eng AS DOUBLE) AS type_engagement
FROM j JOIN s ON j.author_id = s.author_id""",
        _DOCUMENTED,
    )
)
def creator_documents(v):
    """Creator statistics in the nested layout of their collection, read back field by field."""
    rows = stats.creator_stats(v.contents, v.users, v.accounts, AS_OF)
    return to_documents("creatorStats", rows).select(
        F.col("_id").alias("id"),
        F.col("ownerAccount").alias("owner_account"),
        F.col("geolocation.countryCode").alias("country_code"),
        F.col("contentCount").alias("contents"),
        F.col("creatorLikedCount").alias("liked"),
        F.col("aggregator.ageScore").alias("age"),
        F.col("aggregator.followedScore").alias("followed"),
        F.explode("summary").alias("part"),
    ).select(
        "*",
        F.col("part.type").alias("type"),
        F.col("part.typeCount").alias("type_count"),
        F.col("part.aggregator.engagementScore").alias("type_engagement"),
    ).drop("part")


_USES = """
WITH e AS (
  SELECT content_id, author_id, version, created_at, updated_at, coalesce(like_count, 0) AS l,
    comment_count AS c, recast_count AS r, quote_count AS q,
    lower(unnest(regexp_extract_all(message, '#(\\w+)', 1))) AS name
  FROM fx_contents WHERE created_at >= @t0 - INTERVAL 14 DAY)"""


def _hashtag_sql(recast: str, quote: str, eng: str) -> str:
    return duckdb_sql(
        _USES
        + f""",
g AS (
  SELECT name, count(*) AS n, count(DISTINCT author_id) AS people, sum(l) AS l, sum(c) AS c,
    {recast} AS r, {quote} AS q, max(version) AS version, min(created_at) AS created_at,
    max(updated_at) AS updated_at FROM e GROUP BY name),
s AS (SELECT *, {age('updated_at')} AS age, {eng} AS eng FROM g)
SELECT name, n AS hashtag_count, people AS contributor_count, CAST(l AS BIGINT) AS liked_count,
  CAST(c AS BIGINT) AS commented_count, CAST(r AS BIGINT) AS recasted_count,
  CAST(q AS BIGINT) AS quoted_count, version, created_at, updated_at,
  round(people / n, 6) AS diversity_score, round(CAST(eng AS DOUBLE), 6) AS engagement_score,
  round(age, 6) AS age_score, round(people / n * (eng + 1) * age, 6) AS score FROM s""",
        "contents",
    )


@query(_hashtag_sql("sum(r)", "sum(q)", "l + c + r + q"))
def hashtag_stats(v):
    return stats.hashtag_stats(v.contents, AS_OF)


@query(_hashtag_sql("0", "0", "c + r + 2 * q"))
def hashtag_stats_as_coded(v):
    return stats.hashtag_stats(v.contents, AS_OF, as_coded=True)


@query(
    duckdb_sql(
        _USES
        + """
SELECT name, author_id, count(*) AS contribution_count, CAST(sum(l) AS BIGINT) AS liked_count,
  CAST(sum(c) AS BIGINT) AS commented_count, CAST(sum(r) AS BIGINT) AS recasted_count,
  CAST(sum(q) AS BIGINT) AS quoted_count, max(version) AS version, min(created_at) AS created_at,
  max(updated_at) AS updated_at FROM e GROUP BY name, author_id""",
        "contents",
    )
)
def hashtag_contributions(v):
    return stats.hashtag_contributions(stats.hashtag_uses(v.contents, AS_OF))


@query(duckdb_sql(_USES + " SELECT name, author_id, content_id FROM e", "contents"))
def hashtag_documents(v):
    nested = stats.hashtag_documents(v.contents, AS_OF, items_per_row=50)
    return nested.select("name", F.explode("contributions").alias("c")).select("name", "c.*")


@query(
    duckdb_sql(
        _USES.replace("INTERVAL 14 DAY", "INTERVAL 7 DAY")
        + """ SELECT name, author_id, content_id FROM e""",
        "contents",
    )
)
def hashtag_documents_rerun(v):
    """Documents of a week's uses over those of two weeks: no part of the first run stays."""
    first = stats.hashtag_documents(v.contents, AS_OF, items_per_row=5)
    second = stats.hashtag_documents(v.contents, AS_OF, days=7, items_per_row=5)
    merged = upsert.replace_groups(first, second, ["name"], first.select("name"))
    nested = merged.select("name", F.explode("contributions").alias("c"))
    return nested.select("name", "c.*")


_USER_TOTALS = """
WITH t AS (
  SELECT author_id, hashtags, type, count(*) AS n, sum(coalesce(like_count, 0)) AS l,
    sum(comment_count) AS c, sum(recast_count) AS r, sum(quote_count) AS q
  FROM fx_contents WHERE created_at >= @t0 - INTERVAL 14 DAY GROUP BY author_id, hashtags, type)"""


@query(
    duckdb_sql(
        _USER_TOTALS
        + """
SELECT author_id AS user_id, CAST(sum(n) AS BIGINT) AS user_content_count,
  CAST(sum(l) AS BIGINT) AS user_like_count, CAST(sum(c) AS BIGINT) AS user_comment_count,
  CAST(sum(r) AS BIGINT) AS user_recast_count, CAST(sum(q) AS BIGINT) AS user_quote_count,
  any_value(w.owner_account) AS owner_account, any_value(w.display_id) AS display_id,
  any_value(w.created_at) AS created_at, any_value(w.visibility) AS visibility,
  any_value(w.followed_count) AS followed_count, any_value(w.follower_count) AS follower_count
FROM t LEFT JOIN fx_users w ON t.author_id = w.user_id GROUP BY author_id""",
        "contents",
        "users",
    )
)
def user_stats(v):
    return stats.user_stats(v.contents, v.users, AS_OF)


@query(
    duckdb_sql(
        _USER_TOTALS
        + """,
h AS (
  SELECT author_id, hashtags, sum(n) AS hn, sum(l) AS hl, sum(c) AS hc, sum(r) AS hr, sum(q) AS hq
  FROM t GROUP BY author_id, hashtags)
SELECT t.author_id, array_to_string(t.hashtags, ',') AS hashtags,
  CAST(hn AS BIGINT) AS hashtag_content_count, CAST(hl AS BIGINT) AS hashtag_like_count,
  CAST(hc AS BIGINT) AS hashtag_comment_count, CAST(hr AS BIGINT) AS hashtag_recast_count,
  CAST(hq AS BIGINT) AS hashtag_quote_count, t.type, t.n AS type_count,
  CAST(t.l AS BIGINT) AS like_count, CAST(t.c AS BIGINT) AS comment_count,
  CAST(t.r AS BIGINT) AS recast_count, CAST(t.q AS BIGINT) AS quote_count
FROM t JOIN h ON t.author_id = h.author_id AND t.hashtags IS NOT DISTINCT FROM h.hashtags""",
        "contents",
    )
)
def user_documents(v):
    nested = stats.user_documents(v.contents, AS_OF, items_per_row=2)
    per_hashtag = nested.select("author_id", F.explode("hashtag_summary").alias("h")).select(
        "author_id", "h.*"
    )
    flat = per_hashtag.withColumn("entry", F.explode("content_summary")).drop("content_summary")
    return flat.select("*", "entry.*").drop("entry").withColumn(
        "hashtags", F.array_join("hashtags", ",")
    )


_TOPIC_COUNTS = """
SELECT user_id, type, topic_id, count(*) AS count FROM (
  SELECT e.user_id, e.type, unnest(i.topics) AS topic_id
  FROM fx_engagements e JOIN fx_contentinfo i ON e.content_id = i.content_id
  WHERE e.target_ref = 'content') GROUP BY user_id, type, topic_id"""


@query(duckdb_sql(_TOPIC_COUNTS, "engagements", "contentinfo"))
def user_topic_engagement(v):
    return engagement.user_topic_engagement(v.engagements, v.contentinfo)


@query(
    duckdb_sql(
        f"""
WITH n AS ({_TOPIC_COUNTS})
SELECT user_id, type, topic_id, count, '01/31/2024, 00:00:00' AS timestamp FROM n""",
        "engagements",
        "contentinfo",
    )
)
def user_topic_maps(v):
    counts = engagement.user_topic_engagement(v.engagements, v.contentinfo)
    maps = engagement.user_topic_maps(counts, AS_OF)
    columns = [c for c in maps.columns if c.endswith("_topics")]
    long = maps.unpivot(["user_id", "timestamp"], columns, "type", "topics")
    return long.select(
        "user_id",
        F.regexp_replace("type", "_topics$", "").alias("type"),
        F.explode("topics").alias("topic_id", "count"),
        "timestamp",
    )


@query(
    duckdb_sql(
        """
WITH e AS (
  SELECT e.content_id, u.owner_account, e.type FROM fx_engagements e
  LEFT JOIN fx_users u ON e.user_id = u.user_id
  WHERE e.updated_at >= @t0 - INTERVAL 1 DAY AND e.target_ref = 'content'),
j AS (
  SELECT f.source, e.type IN ('like', 'comment', 'recast', 'quote') AS hit
  FROM fx_feeditems f LEFT JOIN e
  ON f.content_id IS NOT DISTINCT FROM e.content_id
    AND f.viewer IS NOT DISTINCT FROM e.owner_account
  WHERE f.updated_at >= @t0 - INTERVAL 1 DAY AND f.score > 0)
SELECT
  round(coalesce(count(*) FILTER (hit AND source = 'personal') * 100.0
    / nullif(count(*) FILTER (source = 'personal'), 0), 0), 2) AS personal_percent,
  round(coalesce(count(*) FILTER (hit AND source = 'global') * 100.0
    / nullif(count(*) FILTER (source = 'global'), 0), 0), 2) AS global_percent,
  round(coalesce(count(*) FILTER (hit) * 100.0 / nullif(count(*), 0), 0), 2) AS overall_percent,
  @t0 AS calculated_at
FROM j""",
        "engagements",
        "users",
        "feeditems",
    )
)
def feed_performance(v):
    return feed.feed_performance(v.feeditems, v.engagements, v.users, AS_OF)


# Table writes: the target holds older user rows, the source newer and partly new ones.

_TARGET = "SELECT user_id, display_id, followed_count FROM fx_users WHERE user_id % 3 <> 0"
_SOURCE = """
SELECT user_id, concat('new ', display_id) AS display_id, followed_count + 1 AS followed_count
FROM fx_users WHERE user_id % 2 = 0"""


def _target(v):
    return v.users.where("user_id % 3 <> 0").select("user_id", "display_id", "followed_count")


def _source(v):
    return v.users.where("user_id % 2 = 0").select(
        "user_id",
        F.concat(F.lit("new "), "display_id").alias("display_id"),
        (F.col("followed_count") + 1).alias("followed_count"),
    )


def _write_sql(body: str) -> str:
    return duckdb_sql(f"WITH t AS ({_TARGET}), s AS ({_SOURCE}) {body}", "users")


@query(
    _write_sql(
        """SELECT * FROM s UNION ALL
SELECT * FROM t WHERE user_id NOT IN (SELECT user_id FROM s)"""
    )
)
def upsert_replace(v):
    return upsert.upsert_replace(_target(v), _source(v), ["user_id"])


def _repeated(v):
    """The source, and each of its rows once more with a later name and count."""
    again = _source(v).select(
        "user_id",
        F.concat("display_id", F.lit(" again")).alias("display_id"),
        (F.col("followed_count") + 100).alias("followed_count"),
    )
    return _source(v).unionByName(again)


@query(
    _write_sql(
        """SELECT user_id, concat(display_id, ' again') AS display_id,
  followed_count + 100 AS followed_count FROM s UNION ALL
SELECT * FROM t WHERE user_id NOT IN (SELECT user_id FROM s)"""
    )
)
def upsert_replace_duplicates(v):
    newest = _repeated(v).withColumn("minus", -F.col("followed_count"))
    merged = upsert.upsert_replace(_target(v), newest, ["user_id"], ["minus"])
    return merged.drop("minus")


@query(
    _write_sql(
        """SELECT t.user_id, t.display_id, coalesce(s.followed_count, t.followed_count)
  AS followed_count FROM t LEFT JOIN s ON t.user_id = s.user_id"""
    )
)
def update_only_duplicates(v):
    return upsert.update_only(
        _target(v), _repeated(v), ["user_id"], ["followed_count"], ["followed_count"]
    )


@query(
    _write_sql(
        """SELECT coalesce(t.user_id, s.user_id) AS user_id, t.display_id,
  coalesce(s.followed_count, t.followed_count) AS followed_count
FROM t FULL JOIN s ON t.user_id = s.user_id"""
    )
)
def upsert_set(v):
    return upsert.upsert_set(_target(v), _source(v), ["user_id"], ["followed_count"])


@query(
    _write_sql(
        """SELECT * FROM t UNION ALL
SELECT * FROM s WHERE user_id NOT IN (SELECT user_id FROM t)"""
    )
)
def insert_only(v):
    twice = _source(v).unionByName(_source(v).withColumn("display_id", F.lit("zz")))
    return upsert.insert_only(_target(v), twice, ["user_id"], ["display_id"])


@query(
    _write_sql(
        """SELECT t.user_id, t.display_id, coalesce(s.followed_count, t.followed_count)
  AS followed_count FROM t LEFT JOIN s ON t.user_id = s.user_id"""
    )
)
def update_only(v):
    return upsert.update_only(_target(v), _source(v), ["user_id"], ["followed_count"])


@query(_write_sql("SELECT * FROM t WHERE user_id NOT IN (SELECT user_id FROM s)"))
def consume(v):
    return upsert.consume(_target(v), _source(v), ["user_id"])
