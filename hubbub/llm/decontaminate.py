"""Benchmark decontamination: a broadcast hash set of test n-grams against all training windows.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. A window
is ``width`` consecutive words of a benchmark item; an item of fewer words is one window. Document
words are named by 64-bit hashes; only runs of words that the benchmark uses are looked up in the hash
set, and every hit is verified on the words themselves.

The set is built and broadcast in slices of about ``slice_words`` benchmark words, all of which a task
looks up: driver and tasks hold the whole benchmark, which is taken to be small beside the texts.

Null and empty texts have no words and no hits. Repeated rows each get their own result. Items whose
text is null or has no words have no windows. Items whose id is null are one item without a name: its
hits count, and so does it, but no id of it is listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from hubbub.llm.common import Words, added, arrow_map, ascii_lowered, byte_set, run_names, steps, text_bytes

#: Benchmark words in one broadcast slice: about 100 MB in a task.
SLICE_WORDS = 1_000_000
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
#: One entry for each run of hit words: bytes in the text, and how many words.
RESULT = [
    StructField("n_words", LongType()),
    StructField("hit_spans", SPANS),
    StructField("hit_items", ArrayType(StringType())),
    StructField("hit_words", ArrayType(IntegerType())),
]


def _words() -> Words:
    return Words(byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)), ascii_lowered())


class Slice:
    """Windows of some items: by length, sorted names beside the words and items of each."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        words, lowered = _words(), ascii_lowered()
        windows: dict[tuple[bytes, ...], set[str | None]] = {}
        vocabulary: dict[bytes, int] = {}
        for item, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = words.bounds(data, np.array([0, len(data)]))
            flat = lowered[data].tobytes()
            own = [flat[a:b] for a, b in zip(starts, ends)]
            vocabulary.update(zip(own, words.names(data, starts, ends).tolist()))
            for i in range(max(1, len(own) - width + 1) if own else 0):
                windows.setdefault(tuple(own[i : i + width]), set()).add(item)
        self.known = np.zeros(1 << 16, bool)
        self.names = np.unique(np.array(list(vocabulary.values()), np.uint64))
        self.known[self.names >> np.uint64(48)] = True
        self.by_length: dict[int, tuple[np.ndarray, dict[tuple[bytes, ...], list[str]]]] = {}
        for length in sorted({len(w) for w in windows}):
            own = {w: list(windows[w]) for w in windows if len(w) == length}
            names = [run_names(np.array([vocabulary[x] for x in w], np.uint64), np.array([0]), length)[0] for w in own]
            self.by_length[length] = np.unique(np.array(names, np.uint64)), own


def _slices(benchmark: DataFrame, width: int, slice_words: int, item: str, text: str) -> list[Slice]:
    """All items, read one slice at a time; the number of slices comes from the benchmark's size."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(
        F.col("text").isNotNull()
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // (5 * slice_words)
    part = F.pmod(F.xxhash64("item"), F.lit(n))
    out = [Slice([tuple(r) for r in rows.where(part == k).toLocalIterator()], width) for k in range(n)]
    return [s for s in out if s.by_length]


def _hits(words: Words, lowered: np.ndarray, part: Slice, data: np.ndarray, offsets: np.ndarray):
    """Hit marks for the words of some texts, bounds of the words, and (text, item) pairs."""
    starts, ends, before = words.bounds(data, offsets)
    marks = np.zeros(len(starts) + 1, np.int64)
    pairs: list[tuple[int, str]] = []
    if len(starts):
        names = words.names(data, starts, ends)
        maybe = np.flatnonzero(part.known[names >> np.uint64(48)])
        place = np.minimum(np.searchsorted(part.names, names[maybe]), len(part.names) - 1)
        used = np.zeros(len(starts), bool)
        used[maybe[part.names[place] == names[maybe]]] = True
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        # How many used words follow on from each place, within its text.
        stop = np.flatnonzero(np.concatenate([~used, [True]]))
        at = np.flatnonzero(used)
        room = np.minimum(stop[np.searchsorted(stop, at)], before[text_of[at] + 1]) - at
        for length, (known, windows) in part.by_length.items():
            begin = at[room >= length]
            if not len(begin):
                continue
            found = run_names(names, begin, length)
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for i in begin[known[place] == found].tolist():
                own = tuple(lowered[data[a:b]].tobytes() for a, b in zip(starts[i : i + length], ends[i : i + length]))
                if items := windows.get(own):
                    marks[i] += 1
                    marks[i + length] -= 1
                    pairs += [(int(text_of[i]), x) for x in items]
    return np.cumsum(marks[:-1]) > 0, starts, ends, before, pairs


def _finder(spark: SparkSession, benchmark: DataFrame, width: int, slice_words: int, item: str, item_text: str):
    """A function from a column of texts to the columns of RESULT."""
    context = spark.sparkContext
    parts = [context.broadcast(s) for s in _slices(benchmark, width, slice_words, item, item_text)]
    schema = pa.schema(
        [
            ("n_words", pa.int64()),
            ("hit_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("hit_items", pa.list_(pa.string())),
            ("hit_words", pa.list_(pa.int32())),
        ]
    )

    words, lowered = _words(), ascii_lowered()

    def step(column: pa.Array) -> list[pa.Array]:
        data, offsets = text_bytes(column)
        n_words, spans, items, counts = [], [], [], []
        for i, j in steps(offsets):
            own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            hit, pairs = None, []
            for part in [p.value for p in parts] or [None]:
                if part is None:
                    starts, ends, before = words.bounds(own, at)
                    hit = np.zeros(len(starts), bool)
                    continue
                now, starts, ends, before, found = _hits(words, lowered, part, own, at)
                hit = now if hit is None else hit | now
                pairs += found
            by_text: dict[int, set[str]] = {}
            for k, x in pairs:
                by_text.setdefault(k, set()).add(x)
            for k in range(j - i):
                a, b = before[k], before[k + 1]
                n_words.append(int(b - a))
                items.append(sorted(by_text.get(k, ()), key=lambda x: (x is None, x)))
                if k not in by_text:
                    spans.append([])
                    counts.append([])
                    continue
                edge = np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
                spans.append(
                    [
                        {"start": int(starts[a + x] - at[k]), "end": int(ends[a + y] - at[k])}
                        for x, y in zip(first, last)
                    ]
                )
                counts.append((last - first + 1).tolist())
        columns = (n_words, spans, items, counts)
        return [pa.array(c, t.type) for c, t in zip(columns, schema)]

    return step


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    slice_words: int = SLICE_WORDS,
    prefix: str = "",
) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``hit_spans``, ``hit_words`` and ``hit_items``.

    ``prefix`` goes before the new names; a column that has one of them already is replaced.
    """
    find = _finder(docs.sparkSession, benchmark, width, slice_words, item, item_text)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        return find(batch.column(batch.schema.get_field_index(text)))

    return added(docs, step, [StructField(prefix + f.name, f.dataType) for f in RESULT])


def _without(column: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without their spans."""
    out = column.to_pylist()
    for i in np.flatnonzero(np.diff(spans.offsets.to_numpy()) > 0).tolist():
        raw, parts, at = out[i].encode(), [], 0
        for s in spans[i].as_py():
            parts.append(raw[at : s["start"]])
            at = s["end"]
        out[i] = b"".join([*parts, raw[at:]]).decode()
    return pa.array(out, pa.string())


def cleaned(marked: DataFrame, drop_share: float = 0.5, text: str = "text", prefix: str = "") -> DataFrame:
    """Documents of ``contaminated`` without the hit spans.

    A document of whose words at least ``drop_share`` are hit goes; others lose their spans and the
    columns that ``contaminated`` added. Texts without hits stay as they are.
    """
    own = [prefix + f.name for f in RESULT]
    n_hit = F.aggregate(prefix + "hit_words", F.lit(0).cast("long"), lambda x, y: x + y)
    keep = marked.where((n_hit == 0) | (n_hit < F.lit(drop_share) * F.col(prefix + "n_words")))

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(batch.schema.get_field_index(text))
        return [_without(column, batch.column(batch.schema.get_field_index(prefix + "hit_spans")))]

    return added(keep, step, [StructField(text, StringType())]).drop(*own).select(
        *[c for c in marked.columns if c not in own]
    )


def removed(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float = 0.5,
    width: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """What ``cleaned`` makes of ``contaminated``, found and removed in one step."""
    find = _finder(docs.sparkSession, benchmark, width, slice_words, item, item_text)
    at = docs.columns.index(text)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, spans, _, counts = find(batch.column(at))
        n_hit = np.array([sum(c) for c in counts.to_pylist()], np.int64)
        keep = (n_hit == 0) | (n_hit < drop_share * n_words.to_numpy())
        columns = list(batch.columns)
        columns[at] = _without(columns[at], spans)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep))

    return arrow_map(docs, step, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: word, hit and item counts, and a digest of the items."""
    marked = contaminated(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "hit_words", "hit_items"
    )
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda x, y: x + y)
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
