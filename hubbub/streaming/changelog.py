"""Per-batch rows of a streaming target, and its current state.

Each micro-batch owns one partition, which a retry overwrites: a batch written twice counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.operators.ordering import first_per_key

SEED_BATCH = -1


class ChangeLog:
    def __init__(self, root: str, keys: Sequence[str], seed: DataFrame):
        """``seed`` holds the rows present before the stream starts; it may be empty."""
        self.spark = seed.sparkSession
        self.root = root
        self.keys = list(keys)
        self.schema = seed.schema
        seed.write.mode("ignore").parquet(f"{root}/batch={SEED_BATCH}")

    def write(self, rows: DataFrame, batch: int) -> None:
        ordered = rows.select(*self.schema.names)
        ordered.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def seed(self) -> DataFrame:
        """The keys present before the stream started, as a stream that delivers them once."""
        rows = self.spark.readStream.schema(self.schema).parquet(f"{self.root}/batch={SEED_BATCH}")
        return rows.select(*self.keys)

    def current(self, before: int | None = None) -> DataFrame:
        """The latest row of each key, from batches earlier than ``before``."""
        rows = self.spark.read.parquet(self.root)
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        return first_per_key(rows, self.keys, [F.col("batch").desc()]).drop("batch")
