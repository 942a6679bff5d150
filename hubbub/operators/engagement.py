"""Topics that users engage with."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.functions.constants import TOPIC_MAP_TYPES
from hubbub.functions.times import utc


def user_topic_engagement(engagements: DataFrame, contentinfo: DataFrame) -> DataFrame:
    """Count of content engagements per (user, type, topic).

    Engagements are counted per content before they meet its topics.
    """
    on_content = (
        engagements.where(F.col("target_ref") == "content")
        .groupBy("user_id", "type", "content_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tagged = contentinfo.where(F.col("topics").isNotNull()).select("content_id", "topics")
    return (
        on_content.join(tagged, "content_id")
        .select("user_id", "type", "n", F.explode("topics").alias("topic_id"))
        .groupBy("user_id", "type", "topic_id")
        .agg(F.sum("n").alias("count"))
    )


def user_topic_maps(counts: DataFrame, as_of: datetime) -> DataFrame:
    """One row per user with a topic -> count map for each engagement type.

    Maps are built from counts already unique per topic. Unknown types are ignored.
    """
    known = counts.where(F.col("type").isin(*TOPIC_MAP_TYPES))
    entry = F.struct(F.col("topic_id").cast("string"), F.col("count"))
    return known.groupBy("user_id").agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("type") == kind, entry))).alias(
                f"{kind}_topics"
            )
            for kind in TOPIC_MAP_TYPES
        ],
        F.lit(utc(as_of).strftime("%m/%d/%Y, %H:%M:%S")).alias("timestamp"),
    )
