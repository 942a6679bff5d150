"""Training sets: engagement labels joined to content features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.functions.constants import CONTENT_FEATURES, ENGAGEMENT_TYPES
from hubbub.functions.times import newer_than


def _type_counts() -> list[Column]:
    return [F.count_if(F.col("type") == kind).alias(kind) for kind in ENGAGEMENT_TYPES]


def country_engagement(
    engagements: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    days: float = 30.0,
) -> DataFrame:
    """Counts of the four engagement types per (content, lower-case country)."""
    recent = engagements.where(newer_than(engagements, "updated_at", as_of, days))
    homes = users.join(
        accounts.select(
            F.col("account_id").alias("owner_account"),
            F.lower("country_code").alias("country_code"),
        ),
        "owner_account",
    ).select("user_id", "country_code")
    return (
        recent.select("user_id", "content_id", "type")
        .join(homes, "user_id")
        .groupBy("content_id", "country_code")
        .agg(*_type_counts())
    )


def account_engagement(
    engagements: DataFrame, users: DataFrame, as_coded: bool = False
) -> DataFrame:
    """Counts of the four engagement types per (account, content), and their sum.

    ``as_coded`` keeps the first engagement of each pair only, by time and id.
    """
    owners = users.select("user_id", F.col("owner_account").alias("account_id"))
    joined = engagements.join(owners, "user_id")
    if as_coded:
        first = F.min_by("type", F.struct("created_at", "id"))
        grouped = joined.groupBy("account_id", "content_id").agg(first.alias("type"))
        counts = grouped.select(
            "account_id",
            "content_id",
            *[
                F.coalesce((F.col("type") == kind).cast("bigint"), F.lit(0).cast("bigint")).alias(
                    kind
                )
                for kind in ENGAGEMENT_TYPES
            ],
        )
    else:
        counts = joined.groupBy("account_id", "content_id").agg(*_type_counts())
    return counts.withColumn("engagements", sum(F.col(kind) for kind in ENGAGEMENT_TYPES))


def content_features(content_stats: DataFrame, creator_stats: DataFrame) -> DataFrame:
    """The twelve model features of each content; missing values are 0."""
    creators = creator_stats.select(
        F.col("creator_id").alias("author_id"),
        F.col("content_count").alias("creator_content_count"),
        "creator_liked_count",
        "creator_commented_count",
        "creator_recasted_count",
        "creator_quoted_count",
    )
    joined = content_stats.join(creators, "author_id", "left")
    return joined.select("content_id", *CONTENT_FEATURES).na.fill(0, list(CONTENT_FEATURES))


def with_features(engagement: DataFrame, features: DataFrame) -> DataFrame:
    """Engagement rows with their content's features, 0 where the content is unknown."""
    joined = engagement.join(features, "content_id", "left")
    return joined.na.fill(0, list(CONTENT_FEATURES))


def weighted_label(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``label``: rarer engagement types of a key weigh more.

    Per key each type has ``n`` engagements (1 when it has none) and weight ``1 - n / sum(n)``.
    """
    sums = rows.groupBy(key).agg(*[F.sum(kind).alias(f"_{kind}") for kind in ENGAGEMENT_TYPES])
    counts = {
        kind: F.when(F.col(f"_{kind}") == 0, F.lit(1)).otherwise(F.col(f"_{kind}"))
        for kind in ENGAGEMENT_TYPES
    }
    total = sum(counts.values())
    weights = sums.select(
        key,
        *[(F.lit(1.0) - count / total).alias(f"_{kind}_weight") for kind, count in counts.items()],
    )
    label = sum(F.col(kind) * F.col(f"_{kind}_weight") for kind in ENGAGEMENT_TYPES)
    return (
        rows.join(weights, key)
        .withColumn("label", label)
        .drop(*[f"_{kind}_weight" for kind in ENGAGEMENT_TYPES])
    )


def eligible_keys(rows: DataFrame, key: str, min_rows: int = 3) -> DataFrame:
    """Keys with at least ``min_rows`` rows."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") >= min_rows)


def eligible_accounts(rows: DataFrame, min_rows: int = 3) -> DataFrame:
    """Accounts with at least ``min_rows`` contents they engaged with exactly once."""
    return eligible_keys(rows.where(F.col("engagements") == 1), "account_id", min_rows)
