"""Batch jobs made incremental: each run takes only the input that is new."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hubbub.operators.stats import content_facts, scored_contents
from hubbub.operators.upsert import upsert_later
from hubbub.sources.sinks import merge_rows, read_table


def drain(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``apply(batch, number)`` over everything available now, then stop."""
    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_states(batch: DataFrame) -> DataFrame:
    """The latest state of each content in a batch, with ``deleted`` where the stream has none."""
    if "deleted" not in batch.columns:
        batch = batch.withColumn("deleted", F.lit(False))
    known = batch.where(F.col("content_id").isNotNull() & F.col("updated_at").isNotNull())
    return upsert_later(known.limit(0), known, ["content_id"], "updated_at")


def refresh_content_stats(
    contents: DataFrame,
    checkpoint: str,
    target: str = "content_facts",
    buckets: int | None = None,
    **parameters,
) -> StreamingQuery:
    """Bring ``target`` up to date with new, changed and withdrawn contents.

    The table holds ``content_facts``, which no time enters; ``current_content_stats`` reads the
    statistics at a moment. A content that does not qualify any more, or whose row says ``deleted``,
    leaves a ``withdrawn`` row with its time. The later state of a content counts: an event of the
    past changes nothing, whenever it comes. A batch repeated after a failure does the same again.
    """

    def apply(batch: DataFrame, number: int) -> None:
        latest = latest_states(batch)
        shown = F.coalesce((F.col("visibility") == "publish") & ~F.col("deleted"), F.lit(False))
        facts = content_facts(latest.where(shown), **parameters).withColumn("withdrawn", F.lit(False))
        gone = latest.where(~shown).select("content_id", "updated_at", F.lit(True).alias("withdrawn"))
        rows = facts.unionByName(gone, allowMissingColumns=True)
        merge_rows(rows, target, ["content_id"], "later", order=["updated_at"], buckets=buckets)

    return drain(contents, apply, checkpoint)


def current_content_stats(
    spark: SparkSession, as_of: datetime, target: str = "content_facts", **parameters
) -> DataFrame:
    """``content_stats`` at ``as_of``, from the refreshed table."""
    spark.catalog.refreshTable(target)
    facts = read_table(spark, target).where(~F.col("withdrawn")).drop("withdrawn")
    return scored_contents(facts, as_of, **parameters)
