"""Session settings the operators rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Joins are left to Catalyst and AQE: a side is broadcast only when its
# measured size is under the threshold, and a partition held by one hot key is split.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Texts are long: ten thousand of them in one Arrow batch would take much of a task's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Keyed state of streams is kept on disk, so it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hubbub")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def named_dir(spark: SparkSession) -> str | None:
    """The folder the cluster names for data that all executors share, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: the named one, else one in the warehouse.

    A local session is one process, so its own temporary folder will do.
    """
    named = named_dir(spark)
    if named is None and spark.sparkContext.master.startswith("local["):
        own = spark.sparkContext.applicationId
        return f"{spark._jvm.System.getProperty('java.io.tmpdir')}/hubbub-{own}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return named or f"{warehouse.rstrip('/')}/_shared"


def saved(rows: DataFrame) -> DataFrame:
    """Rows that several later steps read, computed a single time.

    They are written to the named folder and read back, so they survive the loss of executors and
    come back with a known size; ``scratch`` removes what a job wrote. Without a named folder
    nothing is written: the rows are kept by the executors, and recomputed where one is lost.
    """
    root = named_dir(rows.sparkSession)
    if root is None:
        return rows.persist()
    path = f"{root.rstrip('/')}/saved-{uuid.uuid4()}"
    for folders in _OPEN:
        folders.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, what ``saved`` wrote inside."""
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield
    finally:
        _OPEN.remove(folders)
        for path in folders:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits the named folder to cut lineage; without one they go on without."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None and named_dir(spark) is not None:
        context.setCheckpointDir(shared_dir(spark))
