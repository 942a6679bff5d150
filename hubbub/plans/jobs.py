"""The scheduled jobs: read catalog tables, apply operators, write catalog tables.

Every job takes ``as_of`` and the names of its tables; defaults are the usual names. Source tables
have the flat columns of ``sources.collections``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubbub.functions.constants import CONTENT_FEATURES, ONE_CLASS_MODEL
from hubbub.functions.text import clean_message_v2
from hubbub.functions.times import newer_than
from hubbub.operators import (
    autoencoder as encoders,
    boosting,
    clusters,
    engagement,
    feed,
    features,
    fraud,
    models,
    recommend,
    stats,
    topics,
    upsert,
    vectors,
)
from hubbub.session import saved, scratch
from hubbub.sources.sinks import append_rows, merge_rows, read_table, reload_table, rewrite_table, settle


def cleans_up(job: Callable) -> Callable:
    """A job whose saved intermediates are removed when it ends."""

    @wraps(job)
    def run(spark: SparkSession, *args, **named):
        with scratch(spark):
            return job(spark, *args, **named)

    return run


def content_stats_job(
    spark: SparkSession,
    as_of: datetime,
    contents: str = "contents",
    target: str = "content_stats",
    days: float = 30.0,
    **parameters,
) -> None:
    """Drop rows older than the window, then replace or add the current ones."""
    source = read_table(spark, contents)
    if source.isEmpty():
        return
    settle(spark, target)
    rows = stats.content_stats(source, as_of, days=days, **parameters)
    if spark.catalog.tableExists(target):
        rewrite_table(
            spark,
            target,
            lambda old: upsert.upsert_replace(
                stats.purge_old(old, as_of, days), rows, ["content_id"]
            ),
        )
    else:
        reload_table(rows, target)


def creator_stats_job(
    spark: SparkSession,
    as_of: datetime,
    contents: str = "contents",
    users: str = "users",
    accounts: str = "accounts",
    target: str = "creator_stats",
    **parameters,
) -> None:
    source = read_table(spark, contents)
    if source.isEmpty():
        return
    rows = stats.creator_stats(
        source, read_table(spark, users), read_table(spark, accounts), as_of, **parameters
    )
    merge_rows(rows, target, ["creator_id"])


def hashtag_stats_job(
    spark: SparkSession,
    as_of: datetime,
    contents: str = "contents",
    target: str = "hashtag_stats",
    documents: str = "hashtag_contributions",
    **parameters,
) -> None:
    """Scores per hashtag, and the contributions behind them in nested form."""
    source = read_table(spark, contents)
    merge_rows(stats.hashtag_stats(source, as_of, **parameters), target, ["name"])
    days = parameters.get("days", 14.0)
    merge_rows(stats.hashtag_documents(source, as_of, days), documents, ["name"], "groups")


def user_stats_job(
    spark: SparkSession,
    as_of: datetime,
    contents: str = "contents",
    users: str = "users",
    target: str = "user_stats",
    documents: str = "user_hashtag_summary",
    days: float = 14.0,
) -> None:
    """Totals per author, and the per-hashtag summary in nested form."""
    source = read_table(spark, contents)
    merge_rows(stats.user_stats(source, read_table(spark, users), as_of, days), target, ["user_id"])
    merge_rows(stats.user_documents(source, as_of, days), documents, ["author_id"], "groups")


def user_engagement_job(
    spark: SparkSession,
    as_of: datetime,
    engagements: str = "engagements",
    contentinfo: str = "contentinfo",
    target: str = "user_engagement_stats",
) -> None:
    counts = engagement.user_topic_engagement(read_table(spark, engagements), read_table(spark, contentinfo))
    reload_table(engagement.user_topic_maps(counts, as_of), target)


def feed_performance_job(
    spark: SparkSession,
    as_of: datetime,
    feeditems: str = "feeditems",
    engagements: str = "engagements",
    users: str = "users",
    target: str = "feed_performances",
) -> None:
    row = feed.feed_performance(
        read_table(spark, feeditems), read_table(spark, engagements), read_table(spark, users), as_of
    )
    append_rows(row, target)


@cleans_up
def country_models_job(
    spark: SparkSession,
    as_of: datetime,
    countries: DataFrame,
    engagements: str = "engagements",
    users: str = "users",
    accounts: str = "accounts",
    content_stats: str = "content_stats",
    creator_stats: str = "creator_stats",
    target: str = "country_models",
    days: float = 30.0,
    min_rows: int = 3,
    base: str = "th",
    trees: dict | None = None,
) -> None:
    """A model per country; ``countries`` (one column ``account``) without one get the base's.

    With ``trees``, parameters of ``fit_boosted``, models are boosted trees; their rows have other
    columns than those of ridge models, so they need a target of their own.

    The base model is the one just fitted, or the stored one when the base was not trainable.
    """
    rows = saved(
        features.country_engagement(
            read_table(spark, engagements), read_table(spark, users), read_table(spark, accounts), as_of, days
        )
    )
    fitted = saved(_fit(spark, rows, "country_code", content_stats, creator_stats, as_of,
                  features.eligible_keys(rows, "country_code", min_rows), trees))
    keys = ["account", "model"]
    stored = fitted
    if spark.catalog.tableExists(target):
        stored = upsert.upsert_replace(read_table(spark, target), fitted, keys)
    every = models.base_model_fallback(fitted, countries, base, stored)
    merge_rows(every, target, keys)


@cleans_up
def account_models_job(
    spark: SparkSession,
    as_of: datetime,
    engagements: str = "engagements",
    users: str = "users",
    content_stats: str = "content_stats",
    creator_stats: str = "creator_stats",
    target: str = "account_models",
    days: float = 30.0,
    min_rows: int = 3,
    trees: dict | None = None,
) -> None:
    """A model per account with enough engagement; does nothing while a source is empty.

    ``trees`` as in ``country_models_job``.
    """
    recent = features_window(read_table(spark, content_stats), as_of, days)
    if (
        read_table(spark, engagements).isEmpty()
        or recent.isEmpty()
        or read_table(spark, creator_stats).isEmpty()
    ):
        return
    rows = saved(features.account_engagement(read_table(spark, engagements), read_table(spark, users)))
    fitted = _fit(spark, rows, "account_id", recent, creator_stats, as_of,
                  features.eligible_accounts(rows, min_rows), trees)
    merge_rows(fitted, target, ["account", "model"])


def features_window(content_stats: DataFrame, as_of: datetime, days: float) -> DataFrame:
    return content_stats.where(newer_than(content_stats, "updated_at", as_of, days))


def _fit(spark, rows, key, content_stats, creator_stats, as_of, eligible, trees=None) -> DataFrame:
    content = read_table(spark, content_stats) if isinstance(content_stats, str) else content_stats
    trainable = rows.join(eligible.select(key), key, "left_semi")
    labelled = features.weighted_label(trainable, key)
    known = features.content_features(content, read_table(spark, creator_stats))
    training = features.with_features(labelled, known)
    if trees is not None:
        grown = boosting.fit_boosted(saved(training), key, CONTENT_FEATURES, "label", **trees)
        return boosting.as_models(grown, key, CONTENT_FEATURES, as_of)
    return models.fit_per_key(training, key, CONTENT_FEATURES, "label", as_of)


@cleans_up
def default_feed_job(
    spark: SparkSession,
    as_of: datetime,
    engagements: str = "engagements",
    contents: str = "contents",
    users: str = "users",
    accounts: str = "accounts",
    filtering: str = "contentfiltering",
    target: str = "default_guest",
    min_contents: int = 4,
) -> None:
    listed = recommend.articles(*[read_table(spark, t) for t in (contents, users, accounts, filtering)])
    countable = recommend.listed_contents(read_table(spark, contents), read_table(spark, filtering))
    pairs = saved(recommend.interactions(read_table(spark, engagements), countable, as_of))
    frequent = recommend.min_interaction_users(pairs, min_contents)
    contents_seen = saved(recommend.content_strength(frequent, listed))
    reload_table(recommend.default_feed(contents_seen), target)


def member_recommendations_job(
    spark: SparkSession,
    as_of: datetime,
    engagements: str = "engagements",
    contents: str = "contents",
    users: str = "users",
    accounts: str = "accounts",
    filtering: str = "contentfiltering",
    prefix: str = "",
    k: int = 10,
    autoencoder: dict | None = None,
) -> None:
    """Scores, the two id dictionaries, the content list and the session features.

    ``autoencoder`` (``width`` and other settings of ``fit_autoencoder``) takes that model in place of linear
    factors.
    """
    listed = recommend.articles(*[read_table(spark, t) for t in (contents, users, accounts, filtering)])
    countable = recommend.listed_contents(read_table(spark, contents), read_table(spark, filtering))
    pairs = recommend.interactions(read_table(spark, engagements), countable, as_of, unknown_as="like")
    reload_table(recommend.session_features(pairs), f"{prefix}member_interactions")
    saved = read_table(spark, f"{prefix}member_interactions")
    if autoencoder is None:
        scores, people, items = recommend.member_recommendations(saved, k)
    else:
        scores, people, items = encoders.autoencoder_recommendations(saved, k=k, **autoencoder)
    reload_table(scores, f"{prefix}results_recommend")
    reload_table(people, f"{prefix}person_dict")
    reload_table(items, f"{prefix}content_dict")
    seen = read_table(spark, f"{prefix}content_dict").select("content_id")
    info = listed.join(seen, "content_id", "left_semi").select("content_id", "author", "title")
    reload_table(info, f"{prefix}content_info")


def user_clusters_job(
    spark: SparkSession,
    as_of: datetime,
    engagement_stats: str = "user_engagement_stats",
    topic_table: str = "topics",
    target: str = "user_clustered",
    k: int = 7,
    seed: int = 1,
) -> None:
    """Cluster labels from the stored per-user topic maps."""
    maps = read_table(spark, engagement_stats)
    columns = [c for c in maps.columns if c.endswith("_topics")]
    counts = maps.unpivot(["user_id"], columns, "type", "topics").select(
        "user_id",
        F.regexp_replace("type", "_topics$", "").alias("type"),
        F.explode("topics").alias("topic_id", "count"),
    )
    places = clusters.topic_places(counts, read_table(spark, topic_table))
    vectors = clusters.user_topic_vectors(counts, places)
    labels = clusters.user_clusters(vectors, as_of, k, seed)
    merge_rows(labels, target, ["user_id"], "set", ["model", "user_class", "predicted_at"])


def embedding_topics_job(
    spark: SparkSession,
    topic_vectors: DataFrame,
    filtering: str = "contentfiltering",
) -> None:
    """Class and score of rows without a class; rows carry their message's ``embedding``."""
    rows = topics.untagged(read_table(spark, filtering)).select(
        "content_id", clean_message_v2(F.col("message_en")).alias("message"), "embedding"
    )
    tagged = topics.embedding_topics(rows, topic_vectors).select(
        "content_id", "class", F.col("score").alias("class_score")
    )
    merge_rows(tagged, filtering, ["content_id"], "update", ["class", "class_score"])


@cleans_up
def train_text_vectors_job(
    spark: SparkSession,
    filtering: str = "contentfiltering",
    target: str = "text_vector_model",
    **setting,
) -> None:
    """The model of text vectors, fitted to all messages; ``setting`` goes to ``fit_vectors``."""
    rows = _cleaned(read_table(spark, filtering))
    counts = saved(vectors.bucket_counts(rows, "content_id", "message", setting.get("buckets", vectors.BUCKETS)))
    reload_table(vectors.fit_vectors(counts, **setting), target)


def text_topics_job(
    spark: SparkSession,
    labels: DataFrame,
    filtering: str = "contentfiltering",
    model: str = "text_vector_model",
) -> None:
    """Class and score of rows without a class, from their message; ``labels`` has ``topic`` and ``words``."""
    rows = _cleaned(topics.untagged(read_table(spark, filtering)))
    tagged = topics.text_topics(rows, labels, read_table(spark, model), "content_id").select(
        "content_id", "class", F.col("score").alias("class_score")
    )
    merge_rows(tagged, filtering, ["content_id"], "update", ["class", "class_score"])


def _cleaned(rows: DataFrame) -> DataFrame:
    return rows.select("content_id", clean_message_v2(F.col("message_en")).alias("message"))


def extract_credentials_job(
    spark: SparkSession,
    as_of: datetime,
    feeditems: str = "feeditems",
    target: str = "credentialfeatures",
    n: int = 500,
    minimum: int = 500,
) -> None:
    """Feature rows of active users; rows already stored are left as they are."""
    rows = fraud.last_n(fraud.reading_times(read_table(spark, feeditems)), n, minimum)
    found = fraud.credential_features(rows, as_of).withColumns(
        {
            "verification_status": F.lit(None).cast("boolean"),
            "verified_at": F.lit(None).cast(rows.schema["seen_at"].dataType),
        }
    )
    keys = ["seen_credential", "first_seen_at", "last_seen_at"]
    merge_rows(found, target, keys, "insert", order=["created_at"])


@cleans_up
def train_one_class_job(
    spark: SparkSession,
    as_of: datetime,
    credentials: str = "credentialfeatures",
    target: str = "frauddetectionmlartifacts",
    n: int = 10_000,
    folds: int = 5,
    bot_status: bool = False,
) -> bool:
    """Evaluate over folds, fit on all bots, append the artifact. False when bots are too few.

    The data set is at most ``n`` rows; it is saved because every later step reads it.
    """
    key = F.concat_ws("|", "seen_credential", "first_seen_at", "last_seen_at")
    dataset = fraud.one_class_dataset(read_table(spark, credentials), n).withColumn("row_id", key)
    labelled = saved(fraud.with_label(dataset, bot_status))
    if not fraud.train_gate(labelled, folds, bot_status).first()["trainable"]:
        return False
    splits = saved(fraud.stratified_splits(labelled, "row_id", folds))
    by_fold = fraud.fit_one_class_pca(
        splits.where(F.col("is_train") & (F.col("label") == 0)), as_of
    )
    report = fraud.classification_report(
        fraud.predict_one_class(splits.where(~F.col("is_train")), by_fold)
    )
    final = fraud.fit_one_class_pca(labelled.where(F.col("label") == 0), as_of)
    scores = report.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    used = labelled.agg(F.sort_array(F.collect_list("row_id")).alias("ids"))
    artifact = final.withColumns(
        {"evaluation_report": scores.scalar(), "dataset": used.scalar()}
    )
    append_rows(artifact, target)
    return True


def predict_suspicious_job(
    spark: SparkSession,
    as_of: datetime,
    artifacts: str = "frauddetectionmlartifacts",
    credentials: str = "credentialfeatures",
    target: str = "suspiciouscredentials",
    cooldown_hours: int = 1,
) -> None:
    """Users suspected by the latest artifact; users already waiting stay as they are."""
    if not spark.catalog.tableExists(artifacts):
        return
    artifact = models.latest_artifact(read_table(spark, artifacts), ONE_CLASS_MODEL)
    if artifact.isEmpty():
        return
    rows = read_table(spark, credentials)
    predicted = fraud.predict_one_class(fraud.latest_unverified(rows), artifact)
    found = fraud.suspicious_users(predicted, fraud.last_verified(rows), as_of, cooldown_hours)
    time = rows.schema["verified_at"].dataType
    waiting = found.withColumns(
        {
            "id": F.md5(F.col("seen_credential").cast("string").cast("binary")),
            "verification_status": F.lit(None).cast("boolean"),
            "verified_at": F.lit(None).cast(time),
        }
    )
    merge_rows(waiting, target, ["seen_credential"], "insert", order=["created_at"])


def apply_verification_job(
    spark: SparkSession,
    as_of: datetime,
    credentials: str = "credentialfeatures",
    suspicious: str = "suspiciouscredentials",
    as_coded: bool = False,
) -> None:
    """Copy verifications to the feature rows, then consume them.

    Features are written first: after a failure in between, a second run repeats the same update
    and then consumes.
    """
    waiting = read_table(spark, suspicious)
    rewrite_table(
        spark,
        credentials,
        lambda rows: fraud.apply_verification(rows, waiting, as_of, as_coded)[0],
    )
    rows = read_table(spark, credentials)
    rewrite_table(
        spark,
        suspicious,
        lambda waiting: fraud.apply_verification(rows, waiting, as_of, as_coded)[1],
    )
