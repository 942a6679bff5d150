"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. At each level, runs of one symbol become one symbol; then deterministic coin
tossing names every symbol by where it first differs, bit for bit, from its left neighbour, three times
over, until names are few; phrases begin at local maxima of these names. A phrase is named by a hash of
its symbols and is a symbol of the next level. Where phrases begin depends on a few symbols around, so
equal substrings get the same phrases, and the same phrases of phrases, except near their ends, at
whatever offset they stand.

The fingerprint of a text is the sketch of its phrase names at levels ``LEVELS``, and of phrases that
repeat side by side: the smallest ``SKETCH`` hashes. Texts of all lengths follow this one rule. Likeness is the estimated overlap of two sets of phrases relative to their union.

Null texts count as empty. Equal texts have equal fingerprints. A text without phrases has the empty
fingerprint; two of those are alike (1), and one is unlike any other (0). Repeated rows are neighbours
in the order of (id, text). Null ids come last. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.llm.common import mixed, small_parts

LEVELS = (1, 2, 3)
SKETCH = 64
#: Bytes of text that are parsed together.
STEP = 1 << 19


#: The next name of a symbol by its left neighbour's name and its own, both small: index 256 * left + own.
_LEFT, _OWN = np.divmod(np.arange(1 << 16), 256)
_LOWEST = np.bitwise_count((_LEFT ^ _OWN) ^ ((_LEFT ^ _OWN) - 1)) - 1
_NEXT = np.where(_LEFT == _OWN, 0, (_LOWEST << 1) | ((_OWN >> _LOWEST) & 1)).astype(np.uint8)


def _run_heads(symbols: np.ndarray, of: np.ndarray) -> np.ndarray:
    heads = np.ones(len(symbols), bool)
    heads[1:] = (symbols[1:] != symbols[:-1]) | (of[1:] != of[:-1])
    return np.flatnonzero(heads)


def _tossed(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each name by the lowest bit in which it differs from its left neighbour, and that bit; 0 if equal.

    Neighbours differ, and keep on differing. A text's first symbol has no neighbour: it takes its own
    lowest bit. Names are below 192 from the first toss on, and are tossed by table then.
    """
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = ~names[first]
    if names.dtype == np.uint8:
        return _NEXT[(left.astype(np.uint16) << np.uint16(8)) | names]
    left ^= names
    place = np.bitwise_count(left ^ (left - np.uint64(1))) - np.uint8(1)
    out = (place << np.uint8(1)) | ((names >> place) & np.uint64(1)).astype(np.uint8)
    return np.where(left == 0, np.uint8(0), out)


def _phrases(
    symbols: np.ndarray, of: np.ndarray, values: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the phrases of all texts and the text of each, in order; places of repeated symbols.

    ``values`` are what symbols are added up by, where that is known already.
    """
    heads = _run_heads(symbols, of)
    lengths = np.diff(np.append(heads, len(symbols)))
    runs = np.flatnonzero(lengths > 1)
    repeated = heads[runs]
    own, of = symbols[heads], of[heads]
    values = mixed(own + np.uint64(1)) if values is None else values[heads]
    own[runs] = mixed(own[runs] + lengths[runs].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    values[runs] = mixed(own[runs] + np.uint64(1))
    starts = np.ones(len(own), bool)
    starts[1:] = of[1:] != of[:-1]
    first = np.flatnonzero(starts)
    names = own
    for _ in range(3):
        # Symbols with a run length may equal their neighbour's name by chance only; then the toss is 0.
        names = _tossed(names, first)
        same = np.zeros(len(names), bool)
        same[1:] = (names[1:] == names[:-1]) & ~starts[1:]
        if same.any():
            names = names + (same.view(np.uint8) << np.uint8(6))
    cuts = starts.copy()
    if len(names) > 2:
        # A text's last symbol begins no phrase: what follows it belongs to another text.
        cuts[1:-1] |= (names[1:-1] > names[:-2]) & (names[1:-1] >= names[2:]) & ~starts[1:-1] & ~starts[2:]
        # No phrase of one symbol next to a text's start.
        cuts[1:] &= ~starts[:-1] | starts[1:]
    at = np.flatnonzero(cuts)
    sizes = np.diff(np.append(at, len(own)))
    weights = mixed(np.arange(1, sizes.max() + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    values *= weights[np.arange(len(own)) - np.repeat(at, sizes)]
    return mixed(np.add.reduceat(values, at)), of[at], repeated


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_BYTE_VALUES = mixed(_BYTES + np.uint64(1))


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted sketch of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    symbols, values = _BYTES[data], _BYTE_VALUES[data]
    kept_of, kept = [], []
    for level in LEVELS:
        if not len(symbols):
            break
        below, of_below = symbols, of
        symbols, of, repeated = _phrases(symbols, of, values)
        values = None
        if level > 1:  # a run is one symbol with its length; what it repeats counts too
            kept.append(below[repeated] >> np.uint64(32))
            kept_of.append(of_below[repeated])
        kept.append((symbols + np.uint64(level)) >> np.uint64(32))
        kept_of.append(of)
    if not kept:
        return [np.zeros(0, np.uint32)] * len(texts)
    keys = np.concatenate(kept_of).astype(np.uint64) << np.uint64(32) | np.concatenate(kept)
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1).astype(np.uint64) << np.uint64(32))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [low[a : min(b, a + SKETCH)] for a, b in zip(bounds[:-1], bounds[1:])]


def shown(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated intersection over union of two sets, from the smallest hashes of their union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SKETCH]
    return float(np.isin(union, a, assume_unique=True).astype(int) @ np.isin(union, b, assume_unique=True)) / len(union)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the following text's first."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


COLUMNS = (
    "doc_id {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents in ranges of descending id, each range ended by a copy of the next range's first row.

    Range bounds are quantiles of the ids. The copies are one row per range, found by an aggregate of
    ids, so texts are shuffled once, and no range is more than a share of all rows plus one.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = sorted({x for x in rows.stat.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)})
    below = F.lit(0)
    if cuts:
        # The number of cuts at or below an id, by halving: descending ids have ascending buckets.
        def number(low: int, high: int):
            if low == high:
                return F.lit(len(cuts) - low)
            middle = (low + high) // 2
            return F.when(F.col("doc_id") >= cuts[middle], number(middle + 1, high)).otherwise(number(low, middle))

        below = number(0, len(cuts))
    last = len(cuts) + 1
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(below))
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    found = {r.bucket: r.doc_id for r in heads.collect()}  # one row per range
    order = sorted(found)
    following = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    copies = rows.limit(0).withColumn("ghost", F.lit(1))
    if found:
        ids = [v for b, v in found.items() if b != last]
        is_head = F.col("doc_id").isin([F.lit(x) for x in ids]) if ids else F.lit(False)
        if last in found:  # rows without an id are sorted by text
            is_head = F.coalesce(is_head, F.lit(False)) | F.col("doc_id").isNull()
        before = F.create_map(*[F.lit(x) for b, nxt in following.items() for x in (nxt, b)])
        one = rows.where(is_head).groupBy("bucket", "doc_id").agg(F.min("text").alias("text"))
        copies = one.select("doc_id", "text", before[F.col("bucket")].alias("bucket"), F.lit(1).alias("ghost"))
    return rows.withColumn("ghost", F.lit(0)).unionByName(copies)


def compared(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness; see COLUMNS."""
    n = partitions or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = COLUMNS.format(kind=kind)
    names = [x.split()[0] for x in schema.split(", ")]
    rows = (
        with_next(docs, n)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "ghost", F.desc_nulls_last("doc_id"), "text")
        .select("doc_id", "text", "ghost")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row so far: its next document is still to come
        for whole in batches:
            for batch in small_parts(whole, STEP):
                ids = batch.column(0)
                texts = batch.column(1).to_pylist()
                ghosts = batch.column(2).to_pylist()
                prints = fingerprints([t.encode() for t in texts])
                rows = [] if waiting is None else [waiting]
                rows += list(zip(ids, texts, ghosts, prints))
                # A copy only serves as next document; after it another range begins.
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[2]]
                waiting = rows[-1]
                if not pairs:
                    continue
                changed = [edited(a[1], b[1]) for a, b in pairs]
                of_changed = fingerprints([t.encode() for t in changed])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[0].as_py() for a, _ in pairs], ids.type),
                        pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                        pa.array(changed, pa.string()),
                        pa.array([shown(a[3]) for a, _ in pairs], pa.string()),
                        pa.array([shown(x) for x in of_changed], pa.string()),
                        pa.array([likeness(a[3], x) for (a, _), x in zip(pairs, of_changed)], pa.float64()),
                        pa.array([likeness(a[3], b[3]) for a, b in pairs], pa.float64()),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, schema)
