"""What the operators share: tables, folds, shared folders, and vectorised words of a text batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hubbub.session import shared_dir

#: Bytes of text that one vectorised step takes together; a longer text is a step of its own.
STEP_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all ids that no label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors see.

    The cluster names it in ``spark.checkpoint.dir``; without that it is in the warehouse.
    """
    return f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(rows: DataFrame, files: int | None = None) -> DataFrame:
    """Rows written to the shared folder and read back: computed once, safe from lost executors.

    ``files`` is the most files to write, where the size of the rows is known.
    """
    path = shared_folder(rows.sparkSession)
    (rows if files is None else rows.coalesce(files)).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored(rows: DataFrame, path: str, *by: str) -> DataFrame:
    """Rows written to ``path``, a folder for each value of the columns ``by``, and read back."""
    rows.write.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes what ``stored`` wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(rows: DataFrame) -> DataFrame:
    """Rows checkpointed in the shared folder."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def arrow_map(
    rows: DataFrame,
    step: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: StructType | str,
    finish: Callable[[], None] | None = None,
) -> DataFrame:
    """``step`` applied to each Arrow batch; a batch is cut to about STEP_BYTES times eight.

    ``finish`` is called at the end of each task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_parts(batch, 8 * STEP_BYTES):
                out = step(part)
                if out is not None and out.num_rows:
                    yield out
        if finish is not None:
            finish()

    return rows.mapInArrow(run, schema)


def small_parts(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    if n <= 1 or batch.nbytes <= limit:
        if n:
            yield batch
        return
    yield from small_parts(batch.slice(0, n // 2), limit)
    yield from small_parts(batch.slice(n // 2), limit)


def added(rows: DataFrame, step, fields: list[StructField], finish=None) -> DataFrame:
    """All columns of ``rows`` beside the arrays that ``step(batch)`` returns for ``fields``.

    ``step`` gets the columns under their own names. New columns come last; where a name is taken
    already, the new column replaces the old one.
    """
    names = {f.name for f in fields}
    kept = [f for f in rows.schema.fields if f.name not in names]
    schema = StructType([*kept, *fields])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = step(batch)
        old = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
        return pa.RecordBatch.from_arrays([*old, *new], names=schema.names)

    return arrow_map(rows, run, schema, finish)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offsets between them; a null text has no bytes."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count:
        column = column.fill_null("")
        return text_bytes(column)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit permutation without visible structure (public splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of many texts at once: bounds in bytes, text number and a 64-bit name for each.

    A word is a run of bytes for which ``is_word`` holds, after ``lowered`` mapped each byte; no run
    crosses two texts. Equal words have equal names; a name is a polynomial over the bytes, mixed.
    """

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, is_word: np.ndarray, lowered: np.ndarray):
        self.is_word, self.lowered = is_word, lowered
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(n, self.BASE, np.uint64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n, self.INVERSE, np.uint64))])

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the number of words before each text."""
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = self.is_word[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | first[1:]
        closes = np.zeros(len(data) + 1, bool)
        closes[1:] = inside[:-1] & (~inside[1:] | first[1:])
        starts = np.flatnonzero(opens)
        return starts, np.flatnonzero(closes), np.searchsorted(starts, offsets)

    def names(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.lowered[data].astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * self.down[starts])


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


def ascii_lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def odd_weights(n: int) -> np.ndarray:
    """Odd multipliers without any simple relation between them."""
    return mixed((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def run_names(names: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name for the ``length`` words that begin at each place of ``at``."""
    total = np.full(len(at), length, np.uint64)
    for k, weight in enumerate(odd_weights(length)):
        total += names[at + k] * weight
    return mixed(total)
