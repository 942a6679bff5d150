"""Content, creator, hashtag and user statistics."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.functions.scores import (
    Weights,
    age_score,
    engagement_score,
    engagement_score_without_likes,
)
from hubbub.functions.text import hashtags
from hubbub.functions.times import moment, newer_than
from hubbub.operators.ordering import collect_in_parts

_COUNTS = {
    "like_count": "liked_count",
    "comment_count": "commented_count",
    "recast_count": "recasted_count",
    "quote_count": "quoted_count",
}


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def purge_old(target: DataFrame, as_of: datetime, days: float = 30.0) -> DataFrame:
    """Rows updated after ``as_of - days``."""
    return target.where(F.col("updated_at") > moment(target, "updated_at", as_of - timedelta(days=days)))


def content_facts(contents: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """What the statistics of a published content have that does not depend on the time."""
    return contents.where(F.col("visibility") == "publish").select(
        "content_id",
        "author_id",
        "updated_at",
        "like_count",
        "comment_count",
        "recast_count",
        "quote_count",
        F.coalesce(F.size("photos"), F.lit(0)).alias("photo_count"),
        F.length(F.coalesce("message", F.lit("-"))).alias("character_length"),
        engagement_score(*[F.col(c) for c in _COUNTS], weights).alias("engagement_score"),
        "created_at",
    )


def scored_contents(
    facts: DataFrame,
    as_of: datetime,
    days: float = 30.0,
    half_life_hours: float = 24.0,
    bias: float = 1.0,
) -> DataFrame:
    """``content_facts`` created in the window, with age and decayed score."""
    age = age_score(F.col("updated_at"), moment(facts, "updated_at", as_of), half_life_hours)
    recent = facts.where(newer_than(facts, "created_at", as_of, days))
    score = (F.col("engagement_score") + F.lit(float(bias))) * F.col("age_score")
    return recent.withColumn("age_score", age).withColumn("score", score).drop("created_at")


def content_stats(
    contents: DataFrame,
    as_of: datetime,
    days: float = 30.0,
    weights: Weights = Weights(),
    half_life_hours: float = 24.0,
    bias: float = 1.0,
) -> DataFrame:
    """Features and decayed score of each published content created in the window."""
    return scored_contents(content_facts(contents, weights), as_of, days, half_life_hours, bias)


def creator_stats(
    contents: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    days: float = 30.0,
    weights: Weights = Weights(),
    followed_weight: float = 0.01,
    half_life_hours: float = 24.0,
    bias: float = 1.0,
    as_coded: bool = False,
) -> DataFrame:
    """One row per published creator with an account: totals, score and a per-type summary.

    ``summary`` has one entry per content type. ``as_coded`` follows the literal job: likes left
    out and quotes doubled per type, creator totals zero, the follower weight added as the bias.
    """
    recent = contents.where(
        newer_than(contents, "updated_at", as_of, days) & (F.col("visibility") == "publish")
    )
    per_type = recent.groupBy("author_id", "type").agg(
        F.count(F.lit(1)).alias("type_count"),
        *[_total(source).alias(name) for source, name in _COUNTS.items()],
        F.max("updated_at").alias("updated_at"),
    )
    return creators_from_totals(
        per_type, users, accounts, as_of, weights, followed_weight, half_life_hours, bias, as_coded
    )


def creators_from_totals(
    per_type: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    weights: Weights = Weights(),
    followed_weight: float = 0.01,
    half_life_hours: float = 24.0,
    bias: float = 1.0,
    as_coded: bool = False,
) -> DataFrame:
    """``creator_stats`` from counts, totals and the last update per creator and content type."""
    liked, commented, recasted, quoted = (F.col(name) for name in _COUNTS.values())
    type_engagement = (
        engagement_score_without_likes(commented, recasted, quoted, weights)
        if as_coded
        else engagement_score(liked, commented, recasted, quoted, weights)
    )
    per_type = per_type.withColumns(
        {
            "age_score": age_score(
                F.col("updated_at"), moment(per_type, "updated_at", as_of), half_life_hours
            ),
            "engagement_score": type_engagement + F.lit(float(bias)),
        }
    )
    creators = per_type.groupBy("author_id").agg(
        F.sum("type_count").alias("content_count"),
        *[F.sum(name).alias(f"creator_{name}") for name in _COUNTS.values()],
        F.max("updated_at").alias("last_content_updated_at"),
        F.max("age_score").alias("age_score"),
        F.collect_list(F.struct("type", "type_count", "age_score", "engagement_score")).alias(
            "types"
        ),
    )
    if as_coded:
        creators = creators.withColumns(
            {f"creator_{name}": F.lit(0).cast("bigint") for name in _COUNTS.values()}
        )
    creators = creators.withColumn(
        "engagement_score",
        engagement_score(*[F.col(f"creator_{name}") for name in _COUNTS.values()], weights)
        + F.lit(float(bias)),
    )

    publishers = users.where(F.col("visibility") == "publish").select(
        F.col("user_id").alias("author_id"),
        "owner_account",
        "display_id",
        F.col("created_at").alias("user_created_at"),
        "followed_count",
        "follower_count",
        (F.col("followed_count") * F.lit(float(followed_weight))).alias("followed_score"),
    )
    places = accounts.select(
        F.col("account_id").alias("owner_account"), "country_code", "continent_code"
    )
    joined = creators.join(publishers, "author_id").join(places, "owner_account")

    def summarise(entry: Column) -> Column:
        weight = entry["type_count"] / F.col("content_count")
        share = (entry["engagement_score"] + 1) / (F.col("engagement_score") + 1)
        return F.struct(
            entry["type"].alias("type"),
            entry["type_count"].alias("type_count"),
            weight.alias("type_weight"),
            entry["age_score"].alias("age_score"),
            entry["engagement_score"].alias("engagement_score"),
            F.col("followed_score").alias("followed_score"),
            F.col("last_content_updated_at").alias("last_content_updated_at"),
            (weight * share * entry["age_score"] + F.col("followed_score")).alias("score"),
        )

    final_bias = followed_weight if as_coded else bias
    return joined.select(
        F.col("author_id").alias("creator_id"),
        "owner_account",
        "display_id",
        "user_created_at",
        "last_content_updated_at",
        "followed_count",
        "follower_count",
        "country_code",
        "continent_code",
        "content_count",
        *[f"creator_{name}" for name in _COUNTS.values()],
        "age_score",
        "engagement_score",
        "followed_score",
        (
            F.col("engagement_score") / F.col("content_count") * F.col("age_score")
            + (F.col("followed_score") + F.lit(float(final_bias)))
        ).alias("score"),
        F.transform(F.array_sort("types"), summarise).alias("summary"),
    )


def creator_type_scores(creators: DataFrame) -> DataFrame:
    """The per-type summary of ``creator_stats``, one row per creator and type."""
    return creators.select("creator_id", F.explode("summary").alias("entry")).select(
        "creator_id", "entry.*"
    )


def hashtag_uses(contents: DataFrame, as_of: datetime, days: float = 14.0) -> DataFrame:
    """One row per hashtag occurrence; a tag repeated in a message counts each time."""
    recent = contents.where(newer_than(contents, "created_at", as_of, days))
    version = F.col("version") if "version" in contents.columns else F.lit(None).cast("int")
    return recent.select(
        F.explode(hashtags(F.col("message"))).alias("name"),
        "author_id",
        "content_id",
        *_COUNTS,
        version.alias("version"),
        "created_at",
        "updated_at",
    )


def hashtag_contributions(uses: DataFrame) -> DataFrame:
    """Uses of each hashtag by each author."""
    return uses.groupBy("name", "author_id").agg(
        F.count(F.lit(1)).alias("contribution_count"),
        *[_total(source).alias(name) for source, name in _COUNTS.items()],
        F.max("version").alias("version"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )


def hashtag_stats(
    contents: DataFrame,
    as_of: datetime,
    days: float = 14.0,
    weights: Weights = Weights(),
    half_life_hours: float = 24.0,
    as_coded: bool = False,
) -> DataFrame:
    """Diversity, engagement and decayed score per hashtag.

    The contributions behind a row are the ``hashtag_contributions`` rows of the same name, or
    ``hashtag_documents`` in nested form. ``as_coded`` follows the literal job: recasts and
    quotes read as zero, likes left out.
    """
    contributions = hashtag_contributions(hashtag_uses(contents, as_of, days))
    return hashtags_from_contributions(contributions, as_of, weights, half_life_hours, as_coded)


def hashtags_from_contributions(
    contributions: DataFrame,
    as_of: datetime,
    weights: Weights = Weights(),
    half_life_hours: float = 24.0,
    as_coded: bool = False,
) -> DataFrame:
    """``hashtag_stats`` from totals per hashtag and author."""
    tags = contributions.groupBy("name").agg(
        F.sum("contribution_count").alias("hashtag_count"),
        F.count(F.lit(1)).alias("contributor_count"),
        *[F.sum(name).alias(name) for name in _COUNTS.values()],
        F.max("version").alias("version"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )
    if as_coded:
        zero = F.lit(0).cast("bigint")
        tags = tags.withColumns({"recasted_count": zero, "quoted_count": zero})
    liked, commented, recasted, quoted = (F.col(name) for name in _COUNTS.values())
    engagement = (
        engagement_score_without_likes(commented, recasted, quoted, weights)
        if as_coded
        else engagement_score(liked, commented, recasted, quoted, weights)
    )
    scored = tags.withColumns(
        {
            "diversity_score": F.col("contributor_count") / F.col("hashtag_count"),
            "engagement_score": engagement,
            "age_score": age_score(
                F.col("updated_at"), moment(tags, "updated_at", as_of), half_life_hours
            ),
        }
    )
    return scored.withColumn(
        "score",
        F.col("diversity_score") * (F.col("engagement_score") + 1) * F.col("age_score"),
    )


def hashtag_documents(
    contents: DataFrame, as_of: datetime, days: float = 14.0, items_per_row: int = 100_000
) -> DataFrame:
    """Contributions of each hashtag as nested arrays of (author, content).

    A hashtag with more than ``items_per_row`` uses takes several rows, told apart by ``part``.
    """
    uses = hashtag_uses(contents, as_of, days).select("name", "author_id", "content_id")
    return collect_in_parts(
        uses, ["name"], ["author_id", "content_id"], "contributions", items_per_row
    )


def user_hashtag_stats(contents: DataFrame, as_of: datetime, days: float = 14.0) -> DataFrame:
    """Totals per (author, hashtag list), with one ``content_summary`` entry per content type."""
    recent = contents.where(newer_than(contents, "created_at", as_of, days))
    per_type = recent.groupBy("author_id", "hashtags", "type").agg(
        F.count(F.lit(1)).alias("type_count"),
        *[_total(c).alias(c) for c in _COUNTS],
    )
    return user_hashtags_from_totals(per_type)


def user_hashtags_from_totals(per_type: DataFrame) -> DataFrame:
    """``user_hashtag_stats`` from totals per author, hashtag list and content type."""
    return per_type.groupBy("author_id", "hashtags").agg(
        F.sum("type_count").alias("hashtag_content_count"),
        *[F.sum(c).alias(f"hashtag_{c}") for c in _COUNTS],
        F.array_sort(F.collect_list(F.struct("type", "type_count", *_COUNTS))).alias(
            "content_summary"
        ),
    )


def user_stats(
    contents: DataFrame, users: DataFrame, as_of: datetime, days: float = 14.0
) -> DataFrame:
    """Totals per author with the user's details; authors without a user row are kept.

    The per-hashtag detail is ``user_hashtag_stats``, or ``user_documents`` in nested form.
    """
    return users_from_hashtags(user_hashtag_stats(contents, as_of, days), users)


def users_from_hashtags(per_hashtag: DataFrame, users: DataFrame) -> DataFrame:
    """``user_stats`` from ``user_hashtag_stats``."""
    totals = per_hashtag.groupBy("author_id").agg(
        F.sum("hashtag_content_count").alias("user_content_count"),
        *[F.sum(f"hashtag_{c}").alias(f"user_{c}") for c in _COUNTS],
    )
    details = users.select(
        F.col("user_id").alias("author_id"),
        "owner_account",
        "display_id",
        "created_at",
        "visibility",
        "followed_count",
        "follower_count",
    )
    return totals.join(details, "author_id", "left").withColumnRenamed("author_id", "user_id")


def user_documents(
    contents: DataFrame, as_of: datetime, days: float = 14.0, items_per_row: int = 10_000
) -> DataFrame:
    """``hashtag_summary`` per author in nested form, split over parts for very active authors."""
    per_hashtag = user_hashtag_stats(contents, as_of, days)
    item = [c for c in per_hashtag.columns if c != "author_id"]
    return collect_in_parts(per_hashtag, ["author_id"], item, "hashtag_summary", items_per_row)
