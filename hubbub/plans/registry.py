"""Named queries: a Spark form and, where SQL can express it, a DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from hubbub.plans.sample_views import Views
from hubbub.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Queries whose rows have no SQL form.
ROWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, since two engines add numbers in different orders."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(sql: str | None = None, digits: int = 6):
    """Register ``run(views) -> DataFrame`` under its function name."""

    def register(run: Callable[[Views], DataFrame]):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(run(Views(tune(spark), sf_dir)), digits)

        name = run.__name__
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rows_query(run: Callable[[Views], DataFrame]):
    """Register ``run(views) -> DataFrame``, unrounded and without a SQL counterpart."""
    ROWS[run.__name__] = lambda spark, sf_dir: run(Views(tune(spark), sf_dir))
    return run
