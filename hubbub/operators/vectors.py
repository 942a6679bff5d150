"""Text vectors without an outside encoder: hashed n-gram weights, reduced by a randomised SVD.

A message is its words and pairs of neighbouring words. Each is hashed to one of ``buckets`` numbers; a bucket
weighs ``1 + ln(count)`` times its rarity, and each row has length 1. The space of the vectors is that of the
largest ``rank`` right singular directions of this matrix: a random subspace is multiplied by it and by its
transpose a few times, one pass over the rows each. A pass keeps ``buckets * (rank + MORE)`` sums per task and
sends these to one aggregate per bucket; the driver holds that many numbers and no row. Counts and passes take
all rows.

Null and empty messages, and those without letters, have no entries and a null vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.operators.language import letter_words
from hubbub.operators.sums import summed
from hubbub.session import saved

BUCKETS = 4096
#: Directions beyond the rank that the random subspace has.
MORE = 10
#: Rows that are multiplied together.
ROWS_AT_ONCE = 256

MODEL = "bucket int, rarity double, loadings array<double>"


def ngrams(text: Column) -> Column:
    """Words and pairs of neighbouring words, lower-cased."""
    words = letter_words(text)
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))


def _counted(rows: DataFrame, key: str, alone: Callable[[DataFrame], DataFrame], merged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``alone`` of the rows whose key is on no other row, and ``merged`` of the rest, which need a shuffle.

    Keys are counted without their texts; one that repeats, null too, is one message.
    """
    numbers = rows.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n"))
    again = saved(numbers.where(F.col("_n") > 1).select("_again"))
    if again.isEmpty():
        return alone(rows)
    same = F.col(key).eqNullSafe(F.col("_again"))
    return alone(rows.join(again, same, "left_anti")).unionByName(merged(rows.join(again, same, "left_semi")))


def _counters(buckets: int):
    """Functions for the workers, nested so that they need no copy of this package."""
    step = ROWS_AT_ONCE

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
        """Keys, all values, and the row of each value."""
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                lengths = some.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                if lengths.any():
                    yield some.column(0), some.column(1).flatten(), np.repeat(np.arange(len(some)), lengths)

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, flat, row in slices(batches):
            coded = flat.dictionary_encode()
            names, word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            kinds, next_to = len(names) + 1, row[1:] == row[:-1]
            # A word is followed by 0, a pair's first word by 1 + the second.
            owner, first = np.append(row, row[:-1][next_to]), np.append(word, word[:-1][next_to])
            then = np.append(np.zeros(len(word), np.int64), 1 + word[1:][next_to])
            found, count = np.unique((owner * kinds + first) * kinds + then, return_counts=True)
            owner, first, then = found // kinds**2, found // kinds % kinds, found % kinds
            for some, pair in ((then == 0, False), (then > 0, True)):
                gram = names.take(pa.array(first[some]))
                if pair:
                    gram = pc.binary_join_element_wise(gram, names.take(pa.array(then[some] - 1)), " ")
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(owner[some])), gram, pa.array(count[some], pa.int64())], names=["_key", "gram", "count"]
                )

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, flat, row in slices(batches):
            found, count = np.unique(row * buckets + flat.to_numpy(), return_counts=True)
            owner, starts = np.unique(found // buckets, return_index=True)
            own = pa.StructArray.from_arrays(
                [pa.array(found % buckets, pa.int32()), pa.array(count, pa.int64())], names=["bucket", "count"]
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(found)), pa.int32()), own)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), lists], names=["_key", "entries"])

    return grams, entries


def ngram_counts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, gram, count`` of each message; a message's grams are counted where it is read."""
    rows = rows.select(key, text)
    kind = rows.schema[key].dataType.simpleString()

    def alone(some: DataFrame) -> DataFrame:
        words = some.select(key, letter_words(F.col(text)).alias("words"))
        return words.mapInArrow(_counters(0)[0], f"_key {kind}, gram string, count long").withColumnRenamed("_key", key)

    def merged(some: DataFrame) -> DataFrame:
        grams = some.select(key, F.explode(ngrams(F.col(text))).alias("gram"))
        return grams.groupBy(key, "gram").agg(F.count(F.lit(1)).alias("count"))

    return _counted(rows, key, alone, merged)


def bucket_counts(rows: DataFrame, key: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """``key, entries``: the buckets of each message with their counts, at most ``buckets`` of them."""
    rows = rows.select(key, text)
    kind = rows.schema[key].dataType.simpleString()

    def number(gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")

    def alone(some: DataFrame) -> DataFrame:
        numbers = some.select(key, F.transform(ngrams(F.col(text)), number).alias("numbers"))
        made = numbers.mapInArrow(_counters(buckets)[1], f"_key {kind}, entries array<struct<bucket:int,count:bigint>>")
        return made.withColumnRenamed("_key", key)

    def merged(some: DataFrame) -> DataFrame:
        grams = some.select(key, F.explode(ngrams(F.col(text))).alias("gram"))
        counts = grams.groupBy(key, number(F.col("gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
        return counts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("bucket", "count"))).alias("entries"))

    return _counted(rows, key, alone, merged)


def bucket_rarity(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``1 + ln((1 + rows) / (1 + rows with the bucket))`` for each bucket."""
    total = counts.count()
    found = counts.select(F.explode("entries.bucket").alias("bucket")).groupBy("bucket").count().collect()
    having = np.zeros(buckets)
    for row in found:  # one row per bucket
        having[row["bucket"]] = row["count"]
    return 1 + np.log((1 + total) / (1 + having))


def _reader(buckets: int, rarity: np.ndarray):
    """A function for the workers, nested so that they need no copy of this package."""
    step = ROWS_AT_ONCE

    def blocks(entries: pa.ListArray) -> Iterator[np.ndarray]:
        """Dense unit rows of weights, ``step`` rows at a time."""
        for at in range(0, len(entries), step):
            some = entries.slice(at, step)
            flat = some.flatten()
            row = np.repeat(np.arange(len(some)), np.diff(some.offsets.to_numpy()))
            bucket = flat.field("bucket").to_numpy()
            count = flat.field("count").to_numpy().astype(float)
            dense = np.zeros((len(some), buckets))
            dense[row, bucket] = (1 + np.log(count)) * rarity[bucket]
            yield dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-300)

    return blocks


def _sums(counts: DataFrame, rarity: np.ndarray, basis: np.ndarray, transposed: bool) -> np.ndarray:
    """``A' A basis``, or ``(A basis)' (A basis)``, over all rows of the matrix ``A``."""
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(basis)
    blocks = _reader(len(rarity), rarity)
    side = len(rarity) if transposed else basis.shape[1]

    def part(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        directions = shared.value
        total = np.zeros((side, directions.shape[1]))
        for batch in batches:
            for rows in blocks(batch.column(0)):
                projected = rows @ directions
                total += (rows if transposed else projected).T @ projected
        return total

    out = summed(counts.select("entries"), part, side, basis.shape[1])
    shared.destroy()
    return out


def fit_vectors(counts: DataFrame, rank: int = 64, buckets: int = BUCKETS, passes: int = 4, seed: int = 1) -> DataFrame:
    """The model, one row per bucket: its rarity and its part in each of the ``rank`` directions.

    ``counts`` (of ``bucket_counts``) is read ``passes + 3`` times: pass saved rows. Directions are in the order
    of their singular values; the largest part of each is positive. Where the rows have fewer directions than
    ``rank``, the others are zero.
    """
    rarity = bucket_rarity(counts, buckets)
    width = min(rank + MORE, buckets)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((buckets, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_sums(counts, rarity, basis, transposed=True))[0]
    values, turns = np.linalg.eigh(_sums(counts, rarity, basis, transposed=False))
    order = np.argsort(-values)[:rank]
    loadings = basis @ turns[:, order]
    loadings *= np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(len(order))])
    loadings[:, values[order] <= 1e-12 * max(values.max(), 1e-300)] = 0
    rows = [(i, float(rarity[i]), loadings[i].tolist()) for i in range(buckets)]
    return counts.sparkSession.createDataFrame(rows, MODEL)


def text_vectors(rows: DataFrame, model: DataFrame, key: str, text: str) -> DataFrame:
    """``rows`` with ``embedding``, of length 1; null where a message says nothing the model knows.

    ``model`` is of ``fit_vectors``; its buckets come to the driver and go to every task. ``key`` tells rows apart.
    """
    spark = rows.sparkSession
    parts = sorted(model.select("bucket", "rarity", "loadings").collect())
    rarity = np.array([p["rarity"] for p in parts])
    shared = spark.sparkContext.broadcast(np.array([p["loadings"] for p in parts]))
    blocks = _reader(len(parts), rarity)
    counts = bucket_counts(rows, key, text, len(parts)).withColumnRenamed(key, "_key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loadings = shared.value
        for batch in batches:
            at = 0
            for block in blocks(batch.column(1)):
                found = block @ loadings
                length = np.linalg.norm(found, axis=1)
                seen = length > 1e-9
                unit = list(found / np.where(seen, length, 1)[:, None])
                vectors = pa.array([u if s else None for u, s in zip(unit, seen)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(block)), vectors], names=["_key", "embedding"])
                at += len(block)

    kind = counts.schema["_key"].dataType.simpleString()
    made = counts.mapInArrow(run, f"_key {kind}, embedding array<double>")
    kept = [c for c in rows.columns if c != "embedding"]
    return rows.select(*kept).join(made, F.col(key) == F.col("_key"), "left").drop("_key")
