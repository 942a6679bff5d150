"""Ordered operations that stay balanced when one key owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of a hash prefix in hex digits: 4,096 buckets.
PREFIX_DIGITS = 3


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    The row-number filter is planned as a window group limit, so each task passes on at most one
    row per key before the shuffle.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; at most ``n`` per key and task are shuffled."""
    ranked = df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_row") <= n).drop("_row")


def previous_time(
    df: DataFrame, key: str, time: str, tie_break: str, result: str, bucket_seconds: int = 600
) -> DataFrame:
    """Each row's previous ``time`` within ``key``, without one task for all rows of a key.

    Rows are partitioned by (key, time bucket). The first row of a bucket takes the last time of
    the key's previous non-empty bucket, found from one summary row per key and bucket.
    """
    bucket = F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / F.lit(bucket_seconds))
    bucketed = df.withColumn("_bucket", bucket)
    within = Window.partitionBy(key, "_bucket").orderBy(time, tie_break)
    ends = (
        bucketed.groupBy(key, "_bucket")
        .agg(F.max(time).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(Window.partitionBy(key).orderBy("_bucket")))
        .select(F.col(key).alias("_key"), F.col("_bucket").alias("_of"), "_carried")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_of"))
    return (
        bucketed.withColumn("_within", F.lag(time).over(within))
        .join(ends, same, "left")
        .withColumn(result, F.coalesce("_within", "_carried"))
        .drop("_bucket", "_within", "_carried", "_key", "_of")
    )


def hash_order(
    df: DataFrame, hashed: Column, groups: Sequence[str], tie_break: str, position: str, size: str
) -> DataFrame:
    """Number the rows of each group from 0 in the order of a hex hash, with the group size.

    The hash prefix cuts every group into equal buckets, which are ranked in parallel; a bucket's
    offset is the running count of the buckets before it (at most 4,096 counts per group).
    """
    hex_hash, prefix = "_hash", "_prefix"
    rows = df.withColumn(hex_hash, hashed).withColumn(
        prefix, F.substring(hex_hash, 1, PREFIX_DIGITS)
    )
    keys = [*groups, prefix]
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = whole.orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(whole).alias(size),
        )
    )
    in_bucket = Window.partitionBy(*keys).orderBy(hex_hash, tie_break)
    return (
        rows.withColumn("_rank", F.row_number().over(in_bucket))
        .join(offsets, keys)
        .withColumn(position, F.col("_offset") + F.col("_rank") - 1)
        .drop(hex_hash, prefix, "_rank", "_offset")
    )


def dense_ids(df: DataFrame, key: str, number: str) -> DataFrame:
    """Distinct values of ``key``, numbered 0..n-1 without gaps.

    The numbering depends on the values only, so a recomputed task yields the same numbers.
    """
    distinct = df.select(key).where(F.col(key).isNotNull()).distinct()
    hashed = F.md5(F.col(key).cast("string").cast("binary"))
    return hash_order(distinct, hashed, [], key, number, "_size").drop("_size")


def collect_in_parts(
    rows: DataFrame, keys: Sequence[str], item: Sequence[str], name: str, items_per_row: int
) -> DataFrame:
    """Nest rows as an array per key, over several output rows where a key has many.

    ``part`` numbers the output rows of a key. Ordinary keys have one; a key with more than
    ``items_per_row`` items is spread by hash, so no task or row holds an unbounded array and
    nothing is left out.
    """
    parts = rows.groupBy(*[F.col(key).alias(f"_{key}") for key in keys]).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(items_per_row)).alias("_parts")
    )
    joined = rows.join(parts, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    spread = joined.withColumn("part", F.pmod(F.xxhash64(*item), F.col("_parts")))
    return spread.groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.struct(*item))).alias(name)
    )
