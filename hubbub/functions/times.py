"""Explicit-time helpers: every operator takes ``as_of`` instead of reading a clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

MS_PER_HOUR = 3_600_000


def utc(as_of: datetime) -> datetime:
    """Naive UTC time; a naive input is taken to be UTC already."""
    return as_of.astimezone(timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of


def moment(df: DataFrame, column: str, as_of: datetime) -> Column:
    """``as_of`` as a literal of the column's own time type.

    Matching the type keeps the comparison free of casts on the column, so that it reaches the
    Parquet scan as a pushed filter.
    """
    text = utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(f"{text}+00:00").cast("timestamp")


def newer_than(df: DataFrame, column: str, as_of: datetime, days: float) -> Column:
    """``column >= as_of - days``."""
    return F.col(column) >= moment(df, column, utc(as_of) - timedelta(days=days))


def newer_than_months(df: DataFrame, column: str, as_of: datetime, months: int) -> Column:
    """``column >= as_of - months``, clamped at month ends."""
    return F.col(column) >= moment(df, column, as_of) - F.expr(f"INTERVAL '{int(months)}' MONTH")


def elapsed_ms(later: Column, earlier: Column) -> Column:
    """Whole milliseconds between two times."""
    return F.unix_millis(later.cast("timestamp")) - F.unix_millis(earlier.cast("timestamp"))
