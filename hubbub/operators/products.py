"""The best items of each query by inner product, without scoring all pairs.

Items are sorted by length, longest first, into blocks. Every query meets the first block, whose size is
bounded, and takes the ``k``-th best score there as its threshold. An item shorter than threshold / own length
cannot reach it, by Cauchy and Schwarz, and neither can any item of a later block: a query is sent to the
blocks before that and to no others. The result is exact. Work follows the lengths: where few items are long,
as with factors of popular contents, most queries end in the first block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubbub.session import saved

BLOCK = 4096
#: Scores that a task holds at once: fewer queries at a time meet a larger block.
SCORES_AT_ONCE = 1 << 18


def _by_length(items: DataFrame, block: int) -> DataFrame:
    """``item, vector, length, block``: items in blocks of descending length."""
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = (
        items.withColumn("length", F.sqrt(squares))
        .orderBy(F.col("length").desc(), "item")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    rows = saved(ordered.withColumn("_part", F.shiftright("_row", 33)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    number = F.floor(place / F.lit(block)).cast("long")
    return rows.join(F.broadcast(offsets), "_part").select("item", "vector", "length", number.alias("block"))


def _scorer():
    """Functions for the workers, nested so that they need no copy of this package."""

    def matrix(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0))

    def best(queries, items, vectors, least, k):
        """(query, item place, score) of at most ``k`` items per query that reach ``least``."""
        scores = queries @ vectors.T
        if scores.shape[1] > k:  # the k-th best here is a bound as well
            least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
        i, j = np.nonzero(scores >= least[:, None])
        score = scores[i, j]
        order = np.lexsort((items[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < k
        return i[kept], j[kept], score[kept]

    return matrix, best


def best_products(queries: DataFrame, items: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query, item, score``: the ``k`` items of largest inner product with each query.

    ``queries`` has ``query`` and ``vector``, ``items`` has ``item`` and ``vector``; ids are long and
    vectors of one size. Ties go to the smaller item. One length per block comes to the driver, and
    the first block.
    """
    spark = queries.sparkSession
    asked = queries.select(F.col("query").cast("long").alias("query"), F.col("vector").cast("array<double>").alias("vector"))
    offered = items.select(F.col("item").cast("long").alias("item"), F.col("vector").cast("array<double>").alias("vector"))
    placed = _by_length(offered, block)
    longest = [r[1] for r in sorted(placed.groupBy("block").agg(F.max("length")).collect())]
    if not longest:
        return spark.createDataFrame([], "query long, item long, score double")
    matrix, best = _scorer()
    head = placed.where(F.col("block") == 0).select("item", "vector").toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast(
        (head.column("item").combine_chunks().to_numpy(), matrix(head.column("vector").combine_chunks()))
    )
    bounds = np.array(longest)
    step = max(1, SCORES_AT_ONCE // block)

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, vectors = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                rows = matrix(batch.column(1))
                least = np.full(len(rows), -np.inf)
                i, j, score = best(rows, numbers, vectors, least, k)
                n = np.bincount(i, minlength=len(rows))
                ends = np.cumsum(n)
                full = n == k
                least[full] = score[ends[full] - 1]
                own = np.sqrt((rows * rows).sum(axis=1))
                # Lengths fall from block to block, so the blocks in reach come first.
                reach = own[:, None] * bounds[None, :] * (1 + 1e-9) + 1e-12 >= least[:, None]
                found = pa.StructArray.from_arrays([pa.array(numbers[j]), pa.array(score)], names=["item", "score"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(least),
                        pa.array(reach.sum(axis=1) - 1, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), found),
                    ],
                    names=["query", "vector", "least", "last", "found"],
                )

    met = saved(
        asked.mapInArrow(
            first, "query long, vector array<double>, least double, last long, found array<struct<item:long,score:double>>"
        )
    )
    sent = met.where(F.col("last") >= 1).select(
        F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("block"), F.col("query").alias("id"), "vector", "least"
    )
    rest = placed.where(F.col("block") >= 1).select("block", F.col("item").alias("id"), "vector", F.lit(None).cast("double").alias("least"))
    # The items of a block come before the queries that meet it.
    dealt = rest.unionByName(sent).repartition("block").sortWithinPartitions("block", F.col("least").asc_nulls_first())

    def further(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, numbers, vectors = None, [], None, None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            asks = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (asks[1:] != asks[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(blocks)]):
                part = batch.slice(low, high - low)
                if blocks[low] != current:
                    current, held, numbers = blocks[low], [], None
                if not asks[low]:
                    held.append((part.column(1).to_numpy(), matrix(part.column(2))))
                    continue
                if numbers is None:
                    numbers, vectors = (np.concatenate(x) for x in zip(*held))
                    held = []
                for at in range(0, part.num_rows, step):
                    some = part.slice(at, step)
                    i, j, score = best(matrix(some.column(2)), numbers, vectors, some.column(3).to_numpy(), k)
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(some.column(1).to_numpy()[i]), pa.array(numbers[j]), pa.array(score)],
                            names=["query", "item", "score"],
                        )

    more = dealt.mapInArrow(further, "query long, item long, score double")
    near = met.select("query", F.explode("found").alias("f")).select("query", "f.*")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "item")
    ranked = near.unionByName(more).withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= k).drop("_rank")
