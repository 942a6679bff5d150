"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups.

A group is all documents of one text; its size is the sum of its documents' sizes. Groups, largest
first, go into the bin with the least remaining capacity that still holds them, found in a balanced
tree of remaining capacities. The capacity is the least one tried at which the wanted number of shards
is enough, so shards end up near equal.

So that packing stays small at any input size, groups below ``1 / GRAINS`` of a shard are first put
together, in parallel, to blocks of about that size, and a block is packed as one item. The driver
packs fewer than ``3 * GRAINS * shards`` items. A group larger than a shard's capacity cannot stay
whole: it is cut into the fewest pieces of whole documents that fit.

Null and empty texts are one group of documents of size 1. Repeated rows are separate documents of one
group. An empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubbub.llm.common import written

GRAINS = 4096
#: Hash buckets over which rows of a shard, or of a group that is cut, are numbered.
SALTS = 4096


class Capacities:
    """A treap of (remaining capacity, bin): a balanced tree by hashed priorities."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        x = (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xC2B2AE3D27D4EB4F + 1) & 0xFFFFFFFFFFFFFFFF
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return x ^ (x >> 32)

    def _split(self, node, key):
        """Two trees: keys below ``key``, and the rest."""
        if node is None:
            return None, None
        own, priority, left, right = node
        if own < key:
            a, b = self._split(right, key)
            return (own, priority, left, a), b
        a, b = self._split(left, key)
        return a, (own, priority, b, right)

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return a[0], a[1], a[2], self._merge(a[3], b)
        return b[0], b[1], self._merge(a, b[2]), b[3]

    def add(self, key: tuple[int, int]) -> None:
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, (key, self._priority(key), None, None)), b)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least key of at least ``size``."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            return None
        low, rest = b, []
        while low[2] is not None:
            rest.append(low)
            low = low[2]
        _, b = self._split(b, (low[0][0], low[0][1] + 1))
        self.root = self._merge(a, b)
        return low[0]


def packed(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; items come largest first. One larger than the capacity has its own bin."""
    tree, bins, n = Capacities(), [], 0
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            found = (max(capacity, size), n)
            n += 1
        bins.append(found[1])
        tree.add((found[0] - size, found[1]))
    return bins


def least_capacity(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """A capacity at which ``shards`` bins are enough, and the bins."""
    exact = -(-sum(sizes) // shards)
    for extra in [0, *(2**i for i in range(40))]:
        capacity = exact + exact * extra // 65536 + (extra > 0)
        bins = packed(sizes, capacity)
        if max(bins, default=0) < shards:
            return capacity, bins
    raise ValueError("no capacity found")


def _numbered(rows: DataFrame, part: str, salt: Column, order: list[str], name: str) -> DataFrame:
    """Rows numbered gaplessly from 0 within ``part``, a hash bucket at a time."""
    salted = rows.withColumn("_salt", salt)
    before = Window.partitionBy(part).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy(part, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(part, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(part, "_salt").orderBy(*order)) - 1
    return (
        salted.withColumn("_own", own)
        .join(offsets, [part, "_salt"])
        .withColumn(name, (F.col("_before") + F.col("_own")).cast("long"))
        .drop("_salt", "_before", "_own")
    )


def sharded(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each document."""
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(whole.cast("binary"))).alias("content"),
        )
    )
    groups = rows.groupBy("content").agg(F.sum("size").alias("bytes"), F.max("size").alias("unit"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1, -(-total // shards))
    grain = max(1, share // GRAINS)
    over = groups.where(F.col("bytes") > share).orderBy("content").collect()  # fewer than ``shards``

    # Pieces of groups that are larger than a shard: whole documents, each piece within one shard.
    pieces, per_piece = [], {}
    for g in over:
        content, unit, n = bytes(g.content), g.unit, g.bytes // g.unit
        per_piece[content] = each = max(1, share // unit)
        pieces += [(content, i, unit * min(each, n - i * each)) for i in range(-(-n // each))]

    small = groups.where(F.col("bytes") < grain)
    bucket = F.pmod(F.xxhash64("content"), F.lit(max(1, shards * GRAINS // 64)))
    running = F.sum("bytes").over(
        Window.partitionBy("bucket").orderBy(F.desc("bytes"), "content").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = small.withColumn("bucket", bucket).withColumn(
        "block", F.floor(F.coalesce(running, F.lit(0)) / F.lit(grain)).cast("long")
    )
    large = groups.where((F.col("bytes") >= grain) & (F.col("bytes") <= share))
    items = pd.concat(
        [
            large.select("content", "bytes").toPandas(),
            blocks.groupBy("bucket", "block").agg(F.sum("bytes").alias("bytes")).toPandas(),
            pd.DataFrame(pieces, columns=["content", "piece", "bytes"]),
        ]
    )
    for name in ("content", "bucket", "block", "piece"):
        if name not in items:
            items[name] = None
    items["content"] = [None if x is None or isinstance(x, float) else bytes(x) for x in items["content"]]
    for name in ("bucket", "block", "piece"):
        items[name] = pd.to_numeric(items[name], errors="coerce").fillna(-1).astype("int64")
    items["order"] = [x or b"" for x in items["content"]]
    items = items.sort_values(["bytes", "bucket", "block", "piece", "order"], ascending=[False, True, True, True, True])
    _, bins = least_capacity([int(x) for x in items["bytes"]], shards)
    placed = spark.createDataFrame(
        list(zip(items["content"], items["bucket"].tolist(), items["block"].tolist(), items["piece"].tolist(), bins)),
        "content binary, bucket long, block long, piece long, shard int",
    )
    by_content = placed.where("bucket = -1").select("content", "piece", "shard")
    by_block = placed.where("bucket >= 0").select("bucket", "block", "shard")
    of_group = (
        blocks.join(by_block, ["bucket", "block"])
        .select("content", F.lit(-1).cast("long").alias("piece"), "shard")
        .unionByName(by_content)
    )
    is_over = F.col("content").isin([F.lit(x) for x in per_piece]) if per_piece else F.lit(False)
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    cut_rows = rows.where(is_over)
    if per_piece:
        each = F.create_map(*[F.lit(y) for x, n in per_piece.items() for y in (x.hex(), n)])
        index = _numbered(cut_rows, "content", salt, ["key"], "index")
        cut_rows = index.withColumn("piece", F.floor(F.col("index") / each[F.lower(F.hex("content"))]).cast("long"))
    else:
        cut_rows = cut_rows.withColumn("index", F.lit(0).cast("long")).withColumn("piece", F.lit(-1).cast("long"))
    one = rows.where(~is_over).withColumn("piece", F.lit(-1).cast("long")).unionByName(cut_rows.drop("index"))
    with_shard = written(one.join(of_group, ["content", "piece"]).select("key", "size", "text_crc32", "shard", "content"))
    numbered = _numbered(with_shard, "shard", salt, ["key", "content"], "slot")
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
