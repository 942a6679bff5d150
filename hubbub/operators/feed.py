"""Quality of feed suggestions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.functions.constants import ENGAGEMENT_TYPES
from hubbub.functions.scores import half_even
from hubbub.functions.times import moment, newer_than

_KEYS = ["content_id", "owner_account"]


def feed_performance(
    feeditems: DataFrame,
    engagements: DataFrame,
    users: DataFrame,
    as_of: datetime,
    days: float = 1.0,
) -> DataFrame:
    """Engaged share of suggested feed items in percent: personal, global and overall.

    A feed item counts once per engagement of its (content, account) pair, or once when there is
    none. Both sides are counted per pair before the join, so the pairs are never multiplied out.
    """
    shown = (
        feeditems.where(newer_than(feeditems, "updated_at", as_of, days) & (F.col("score") > 0))
        .groupBy("content_id", F.col("viewer").alias("owner_account"), "source")
        .agg(F.count(F.lit(1)).alias("items"))
    )
    recent = engagements.where(
        newer_than(engagements, "updated_at", as_of, days) & (F.col("target_ref") == "content")
    )
    reactions = (
        recent.join(users.select("user_id", "owner_account"), "user_id", "left")
        .groupBy(*[F.col(key).alias(f"_{key}") for key in _KEYS])
        .agg(
            F.count(F.lit(1)).alias("reactions"),
            F.count_if(F.col("type").isin(*ENGAGEMENT_TYPES)).alias("engaged"),
        )
    )
    matched = shown.join(
        reactions, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in _KEYS], "left"
    )
    rows = F.col("items") * F.greatest(F.coalesce("reactions", F.lit(1)), F.lit(1))
    hits = F.col("items") * F.coalesce("engaged", F.lit(0))

    def percent(keep: Column) -> Column:
        total = F.sum(F.when(keep, rows))
        share = F.try_divide(F.sum(F.when(keep, hits)), total) * 100
        return half_even(F.coalesce(share, F.lit(0.0)), 2)

    return matched.agg(
        percent(F.col("source") == "personal").alias("personal_percent"),
        percent(F.col("source") == "global").alias("global_percent"),
        percent(F.lit(True)).alias("overall_percent"),
    ).withColumn("calculated_at", moment(feeditems, "updated_at", as_of))
