"""Exact top-k search by integer inner product, in blocks of descending length.

Each component x becomes ``floor(scale * x)``. Vectors are sorted by length, longest first, and numbered;
``BLOCK`` neighbours form a block. All vectors are rotated by the right singular vectors of the whole
table, which moves most of a product into the first few components and changes no product. A query first
meets the block of the longest vectors, which gives it a threshold: its k-th best score so far. By Cauchy
and Schwarz it can leave out every block whose longest vector times its own length is below that, and,
since blocks are sorted by length, all blocks after it. Within a block a pair is given up as soon as its
partial sum plus the product of both remaining lengths is below the threshold. Pairs that are left are
multiplied in whole numbers, so scores are exact; floats only prune, with room for their rounding.

Queries are rows for which a condition holds; candidates are all rows but the query's own row. A vector
that is null or holds a null or non-finite component takes no part, neither as query nor as candidate. A
shorter vector counts as padded by zeros, so an empty one scores 0 with all. Repeated rows, also with one
id, are rows of their own: each repeated query has its own k rows. Ties go to the smaller id; a row
without an id is a candidate, last among ties. Components times ``scale`` and scores must fit 64 bits.
Columns beside the id and the vector are ignored. An empty table gives no rows.

Only the longest block (``BLOCK`` rows), one length per block and a matrix of dimension squared pass the
driver. Queries go to the blocks that they need; a block is one task's at a time, whatever its vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubbub.llm.common import written

BLOCK = 8192
#: Queries that are multiplied with a block at once, and pairs multiplied exactly at once.
QUERIES_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 16
#: Shares of the table's squared length after whose leading components a pair may be given up.
STAGES = (0.5, 0.85)
_NO_ID = np.iinfo(np.int64).max


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows, padded by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    if len(values):
        row = np.repeat(np.arange(len(column)), lengths)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


class Block:
    """Candidate vectors with their rotated leading parts and the lengths of what remains."""

    def __init__(self, places, ids, whole, rotation, stages):
        self.places, self.ids, self.whole = places, ids, whole
        self.turned = whole.astype(np.float64) @ rotation
        self.rest = [_lengths(self.turned[:, h:]) for h in stages]


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole-number products of row pairs, some at a time."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        out[part] = np.einsum("ij,ij->i", a[i[part]], b[j[part]])
    return out


def best_in_block(block: Block, places, whole, least, k, rotation, stages):
    """For each query the candidates of one block that may be among its best k: (query, candidate, score).

    ``least`` holds each query's k-th best score elsewhere, or minus infinity.
    """
    if not len(places) or not len(block.places):
        none = np.zeros(0, np.int64)
        return none, none, none
    turned = whole.astype(np.float64) @ rotation
    room = 1e-9 * (_lengths(turned)[:, None] * _lengths(block.turned).max() + 1)
    h = stages[0]
    part = turned[:, :h] @ block.turned[:, :h].T
    own = places[:, None] == block.places[None, :]
    part[own] = -np.inf
    least = least.copy()
    if block.whole.shape[0] > k:  # k good guesses raise the threshold before anything is pruned
        j = np.argpartition(-part, k - 1, axis=1)[:, :k]
        i = np.repeat(np.arange(len(places)), k)
        score = exact(whole, block.whole, i, j.ravel()).reshape(-1, k).astype(np.float64)
        score[np.take_along_axis(own, j, 1)] = -np.inf
        least = np.maximum(least, score.min(axis=1))
    rest = _lengths(turned[:, h:])[:, None] * block.rest[0][None, :]
    i, j = np.nonzero((part + rest + room >= least[:, None]) & ~own)
    for h, rests in zip(stages[1:], block.rest[1:]):
        if len(i) == 0:
            break
        part = np.concatenate(
            [
                np.einsum("ij,ij->i", turned[i[at : at + PAIRS_AT_ONCE], :h], block.turned[j[at : at + PAIRS_AT_ONCE], :h])
                for at in range(0, len(i), PAIRS_AT_ONCE)
            ]
        )
        ahead = part + _lengths(turned[:, h:])[i] * rests[j] + room[i, 0] >= least[i]
        i, j = i[ahead], j[ahead]
    score = exact(whole, block.whole, i, j)
    ahead = score.astype(np.float64) + room[i, 0] >= least[i]
    i, j, score = i[ahead], j[ahead], score[ahead]
    order = np.lexsort((block.places[j], block.ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], j[rank < k], score[rank < k]


def numbered(vectors: DataFrame, is_query: Column, scale: int, id: str, vector: str) -> DataFrame:
    """Whole-number vectors, longest first, with their ``place`` in that order; written once."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = vectors.where(F.coalesce(finite, F.lit(False))).select(
        F.col(id).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("whole"),
    )
    squares = F.aggregate("whole", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = (
        whole.withColumn("length", F.sqrt(squares))
        .orderBy(F.col("length").desc(), F.col("vec_id").asc_nulls_last(), "whole")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    kept = written(ordered.withColumn("_part", F.shiftright("_row", 33)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(F.broadcast(offsets), "_part").select(place.alias("place"), "vec_id", "asks", "whole", "length")


def rotation_of(rows: DataFrame, width: int) -> tuple[np.ndarray, list[int]]:
    """Right singular vectors of all rows, strongest first, and where the stages of ``STAGES`` end."""

    def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            whole = matrix_of(batch.column(0), width).astype(np.float64)
            total += whole.T @ whole
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "value"])

    gram = np.zeros(width * width)
    sums = rows.select("whole").mapInArrow(squares, "cell long, value double").groupBy("cell").agg(F.sum("value"))
    for cell, value in sums.collect():
        gram[cell] = value
    strength, turns = np.linalg.eigh(gram.reshape(width, width))
    order = np.argsort(-strength)
    share = np.cumsum(np.maximum(strength[order], 0))
    ends = [int(np.searchsorted(share, s * share[-1])) + 1 for s in STAGES] if width else []
    return np.ascontiguousarray(turns[:, order]), sorted({min(e, width) for e in ends})


def top_inner_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    block: int = BLOCK,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of each query."""
    spark = vectors.sparkSession
    rows = numbered(vectors, is_query, scale, id, vector).withColumn("block", F.floor(F.col("place") / block))
    facts = sorted(rows.groupBy("block").agg(F.max("length"), F.max(F.size("whole"))).collect())
    if not facts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, max(f[2] for f in facts))
    longest = np.array([f[1] for f in facts])
    rotation, stages = rotation_of(rows, width)

    first = rows.where(F.col("block") == 0).select("place", "vec_id", "whole").toArrow().combine_chunks()
    first = [first.column(c).combine_chunks() for c in ("place", "vec_id", "whole")]
    shared = spark.sparkContext.broadcast(
        (first[0].to_numpy(), ids_of(first[1]), matrix_of(first[2], width), rotation)
    )
    found_type = "array<struct<vec_id:long,place:long,score:long>>"

    def ask_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Block(*shared.value, stages)
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES_AT_ONCE):
                part = batch.slice(at, QUERIES_AT_ONCE)
                whole = matrix_of(part.column(2), width)
                least = np.full(part.num_rows, -np.inf)
                i, j, score = best_in_block(head, part.column(0).to_numpy(), whole, least, k, shared.value[3], stages)
                n = np.bincount(i, minlength=part.num_rows)
                full = n == k
                least[full] = score[np.cumsum(n)[full] - 1]
                lengths = _lengths(whole.astype(np.float64))
                # A block is needed while its longest vector could still reach the threshold.
                reach = lengths[:, None] * longest[None, :] * (1 + 1e-9) + 1e-6 >= least[:, None]
                last = len(longest) - 1 - np.argmax(reach[:, ::-1], axis=1)
                last[~reach.any(axis=1)] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(least),
                        pa.array(last, pa.int64()),
                        _found(n, head, j, score),
                    ],
                    names=["place", "query_id", "whole", "least", "last", "found"],
                )

    queries = written(
        rows.where("asks")
        .select("place", "vec_id", "whole")
        .mapInArrow(
            ask_first,
            f"place long, query_id long, whole array<long>, least double, last long, found {found_type}",
        )
    )
    columns = "block long, place long, vec_id long, whole array<long>, least double"
    candidates = rows.where(F.col("block") > 0).select(
        "block", "place", "vec_id", "whole", F.lit(None).cast("double").alias("least")
    )
    asked = queries.where(F.col("last") >= 1).select(
        F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("block"),
        "place",
        F.col("query_id").alias("vec_id"),
        "whole",
        "least",
    )
    # Candidates of a block come before the queries that meet it.
    dealt = candidates.unionByName(asked).repartition("block").sortWithinPartitions("block", F.col("least").asc_nulls_first())

    def ask_rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = shared.value[3]
        current, held, here = None, [], None
        for batch in batches:
            number = batch.column(0).to_numpy()
            asks = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                if high == low:
                    continue
                if number[low] != current:
                    current, held, here = number[low], [], None
                part = batch.slice(low, high - low)
                place, ids, whole = part.column(1).to_numpy(), ids_of(part.column(2)), matrix_of(part.column(3), width)
                if not asks[low]:
                    held.append((place, ids, whole))
                    continue
                if here is None:
                    here = Block(*[np.concatenate(x) for x in zip(*held)], turns, stages)
                    held = []
                least = part.column(4).to_numpy()
                for at in range(0, len(place), QUERIES_AT_ONCE):
                    some = slice(at, at + QUERIES_AT_ONCE)
                    i, j, score = best_in_block(here, place[some], whole[some], least[some], k, turns, stages)
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(place[some][i]),
                                part.column(2).slice(at, QUERIES_AT_ONCE).take(pa.array(i)),
                                _ids(here.ids[j]),
                                pa.array(here.places[j]),
                                pa.array(score),
                            ],
                            names=["q", "query_id", "vec_id", "place", "score"],
                        )

    rest = dealt.select(*[c.split()[0] for c in columns.split(", ")]).mapInArrow(
        ask_rest, "q long, query_id long, vec_id long, place long, score long"
    )
    head = queries.select(F.col("place").alias("q"), "query_id", F.explode("found").alias("f")).select("q", "query_id", "f.*")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "place")
    ranked = head.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == _NO_ID)


def _found(n: np.ndarray, block: Block, j: np.ndarray, score: np.ndarray) -> pa.Array:
    """The best candidates of each query as one list."""
    items = pa.StructArray.from_arrays(
        [_ids(block.ids[j]), pa.array(block.places[j]), pa.array(score)], names=["vec_id", "place", "score"]
    )
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), items)
