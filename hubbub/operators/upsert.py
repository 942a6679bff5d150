"""Table-to-table forms of the write operations: each returns the next state of a target table.

Where the table format has row-level MERGE, ``sources.sinks`` hands the source to it instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubbub.operators.ordering import first_per_key


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The source row of each key that comes first by ``order``, then by all its columns."""
    known = {f.name: f.dataType for f in source.schema.fields}
    rest = [c for c in source.columns if c not in keys and c not in order]
    ranks = [F.col(c) if known[c].typeName() != "map" else F.to_json(c) for c in [*order, *rest]]
    return first_per_key(source, keys, ranks or [F.col(c) for c in keys])


def upsert_replace(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Matched rows are replaced by the source row, unmatched source rows are added.

    Of several source rows with one key the first by ``order`` is taken, here and in all merges.
    """
    incoming = one_per_key(source, keys, order)
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(kept, allowMissingColumns=True)


def upsert_later(target: DataFrame, source: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Of each key the row with the latest ``time``; the one that comes now where both are of one time.

    Rows of the past never replace what is known, in whatever order they arrive.
    """
    incoming = one_per_key(source.withColumn("_age", -F.unix_micros(F.col(time).cast("timestamp"))), keys, ["_age"]).drop("_age")
    both = target.withColumn("_new", F.lit(0)).unionByName(
        incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(both, keys, [F.col(time).desc_nulls_last(), F.col("_new").desc()]).drop("_new")


def replace_groups(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    touched: DataFrame | None = None,
) -> DataFrame:
    """All rows of the touched keys, by default the source's, are replaced by the source's rows."""
    gone = (source if touched is None else touched).select(*keys).distinct()
    kept = target.join(gone, list(keys), "left_anti")
    return source.unionByName(kept, allowMissingColumns=True)


def upsert_set(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Matched rows get the named fields set, unmatched source rows are added."""
    return _set_fields(target, one_per_key(source, keys, order), keys, fields, "full")


def update_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Matched rows get the named fields set; source rows without a match are ignored."""
    return _set_fields(target, one_per_key(source, keys, order), keys, fields, "left")


def _set_fields(target, source, keys, fields, how):
    incoming = source.select(
        *keys, F.lit(True).alias("_found"), *[F.col(f).alias(f"_new_{f}") for f in fields]
    )
    joined = target.join(incoming, list(keys), how)
    columns = list(target.columns) + [f for f in fields if f not in target.columns]
    return joined.select(
        *[
            F.when(F.col("_found"), F.col(f"_new_{c}"))
            .otherwise(F.col(c) if c in target.columns else F.lit(None))
            .alias(c)
            if c in fields
            else F.col(c)
            for c in columns
        ]
    )


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Source rows whose key is new are added; existing rows never change.

    Of several source rows with one key the first by ``order`` is taken.
    """
    fresh = first_per_key(source, keys, [F.col(c) for c in order])
    new_rows = fresh.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new_rows, allowMissingColumns=True)


def consume(source: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source without its processed rows."""
    return source.join(done.select(*keys), list(keys), "left_anti")
