"""Sums of fixed-size matrices that tasks make, one aggregate per row of the matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(rows: DataFrame, part: Callable[[Iterable[pa.RecordBatch]], np.ndarray], height: int, width: int) -> np.ndarray:
    """The sum over all tasks of the ``height`` x ``width`` matrix that ``part`` makes of a task's batches.

    Rows of zeros stay in the task. The driver gets one matrix.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.float64()))], names=["at", "sums"]
        )

    parts = rows.mapInArrow(run, "at int, sums array<double>")
    columns = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    out = np.zeros((height, width))
    for row in parts.groupBy("at").agg(*columns).collect():  # one row per row of the matrix
        out[row["at"]] = row[1:]
    return out
