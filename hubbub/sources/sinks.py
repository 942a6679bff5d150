"""Writing results to catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hubbub.operators import upsert

#: The column by which merged tables are partitioned.
BUCKET = "_bucket"
_KEYS, _BUCKETS, _TOUCHED = "hubbub.keys", "hubbub.buckets", "hubbub.touched"


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table's rows without the column that only places them."""
    return spark.table(table).drop(BUCKET)


def reload_table(rows: DataFrame, table: str) -> None:
    """Replace the whole table. An empty result leaves an empty table, not a missing one."""
    rows.write.mode("overwrite").saveAsTable(table)


def append_rows(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").saveAsTable(table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_properties(spark: SparkSession, table: str, **values: str) -> None:
    items = ", ".join(f"'{name}' = '{value}'" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({items})")


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """The keys and number of parts of a bucketed table, nothing for a plain one."""
    found = _properties(spark, table)
    if _KEYS not in found or _BUCKETS not in found:
        return None
    return found[_KEYS].split(","), int(found[_BUCKETS])


def _bucket(rows: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _write_bucketed(rows: DataFrame, table: str, keys: Sequence[str], buckets: int | None) -> None:
    """A new table of ``rows`` with one folder, and normally one file, for each part.

    Without ``buckets`` there are as many parts as a shuffle of the session has.
    """
    buckets = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.drop(BUCKET).withColumn(BUCKET, _bucket(rows, keys, buckets))
    placed.repartition(BUCKET).write.partitionBy(BUCKET).saveAsTable(table)
    _set_properties(rows.sparkSession, table, **{_KEYS: ",".join(keys), _BUCKETS: str(buckets)})


def _staging(table: str) -> str:
    return f"{table}__next"


def _staged_parts(table: str) -> str:
    return f"{table}__parts"


def settle(spark: SparkSession, table: str) -> None:
    """Finish a write that stopped half way.

    A staging table is registered only when it is completely written. One without its table is the
    next state of that table. Staged parts that name what they touch are put in place again, which
    changes nothing where they are already; others are dropped.
    """
    staging, parts = _staging(table), _staged_parts(table)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(staging):
        layout = _layout(spark, staging)
        if layout is None:
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        else:  # not every catalog moves the folders of parts with a name
            _write_bucketed(read_table(spark, staging), table, *layout)
            spark.sql(f"DROP TABLE {staging}")
    if spark.catalog.tableExists(parts):
        if _TOUCHED in _properties(spark, parts):
            _put_parts(spark, table)
        else:
            spark.sql(f"DROP TABLE {parts}")


def rewrite_table(
    spark: SparkSession, table: str, next_state: Callable[[DataFrame], DataFrame]
) -> None:
    """Write ``next_state(current)`` beside the table, then put it in the table's place.

    The current table is only dropped once the new one is complete; ``settle`` covers a stop
    between the two. Other sessions that have read the table need ``REFRESH TABLE`` to see the
    new files.
    """
    settle(spark, table)
    layout = _layout(spark, table)
    rows = next_state(read_table(spark, table))
    if layout is not None:
        _replace(spark, table, rows, range(layout[1]))
        return
    staging = _staging(table)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    rows.write.saveAsTable(staging)
    spark.sql(f"DROP TABLE {table}")
    settle(spark, table)


def bucket_table(spark: SparkSession, table: str, keys: Sequence[str], buckets: int | None = None) -> None:
    """Rewrite a table once, so that merges on ``keys`` write touched parts only."""
    settle(spark, table)
    staging = _staging(table)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    _write_bucketed(read_table(spark, table), staging, keys, buckets)
    spark.sql(f"DROP TABLE {table}")
    settle(spark, table)


def _numbers(touched: DataFrame, table: str) -> list[int]:
    """The parts of a bucketed table in which the keys of ``touched`` are."""
    spark = touched.sparkSession
    keys, buckets = _layout(spark, table)
    types = dict(spark.table(table).dtypes)
    typed = touched.select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    return sorted(r[0] for r in typed.select(_bucket(typed, keys, buckets)).distinct().collect())


def touched_parts(touched: DataFrame, table: str) -> DataFrame:
    """The rows of a bucketed table in the parts that hold the keys of ``touched``; no others are read."""
    stored = touched.sparkSession.table(table)
    return stored.where(F.col(BUCKET).isin(_numbers(touched, table))).drop(BUCKET)


def replace_parts(
    spark: SparkSession,
    table: str,
    touched: DataFrame,
    next_state: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace the parts of a bucketed table that hold the keys of ``touched``.

    ``next_state`` gets the rows of those parts and returns what they become; its rows must keep to
    the same parts. Only those parts are read and written: the files of all others stay as they are.
    At most the table's number of parts comes to the driver.
    """
    settle(spark, table)
    numbers = _numbers(touched, table)
    if numbers:
        stored = spark.table(table).where(F.col(BUCKET).isin(numbers)).drop(BUCKET)
        _replace(spark, table, next_state(stored), numbers)


def _replace(spark: SparkSession, table: str, rows: DataFrame, numbers: Iterable[int]) -> None:
    """Stage ``rows`` as the parts ``numbers``, then put them in place. A new column is added first."""
    keys, buckets = _layout(spark, table)
    known = spark.table(table).columns
    for field in rows.schema.fields:
        if field.name not in known:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{field.name}` {field.dataType.simpleString()})")
    types = dict(spark.table(table).drop(BUCKET).dtypes)
    typed = rows.select(
        *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
    )
    placed = typed.withColumn(BUCKET, _bucket(typed, keys, buckets))
    parts = _staged_parts(table)
    placed.repartition(BUCKET).write.partitionBy(BUCKET).saveAsTable(parts)
    _set_properties(spark, parts, **{_TOUCHED: ",".join(map(str, numbers))})
    _put_parts(spark, table)


def _put_parts(spark: SparkSession, table: str) -> None:
    """Put staged parts in the place of a table's own; parts without rows become empty."""
    parts = _staged_parts(table)
    touched = {int(x) for x in _properties(spark, parts)[_TOUCHED].split(",")}
    rows = spark.table(parts)
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    columns = spark.table(table).columns
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*columns).repartition(BUCKET).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    _remove_parts(spark, table, touched - filled)
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {parts}")


def _remove_parts(spark: SparkSession, table: str, numbers: Iterable[int]) -> None:
    for number in numbers:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {number})")


#: Table formats whose tables take a row-level MERGE.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")


def has_row_level_merge(spark: SparkSession, table: str) -> bool:
    """Whether the table's format merges row by row."""
    facts = spark.sql(f"DESCRIBE EXTENDED {table}").where("lower(col_name) = 'provider'").collect()
    return bool(facts) and (facts[0]["data_type"] or "").lower() in ROW_LEVEL_FORMATS


def merge_rows(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    kind: str = "replace",
    fields: Sequence[str] = (),
    order: Sequence[str] = (),
    row_level: bool | None = None,
    touched: DataFrame | None = None,
    buckets: int | None = None,
) -> None:
    """Merge rows into a table on ``keys``.

    ``kind`` is ``replace``, ``set`` (only ``fields``), ``insert`` (new keys only), ``update``
    (only ``fields`` of existing rows), ``groups`` (all rows of a key are replaced), ``later`` (the
    row with the later ``order[0]``, a time, stays) or ``consume`` (rows of the source's keys go). Of several source rows with one key the first by ``order`` is
    taken, except by ``groups``. ``touched`` names the keys that ``groups`` replaces, if these are
    more than the source has.

    A table that does not exist is made with ``buckets`` parts by a hash of its keys. Later merges
    read and write the parts that the source touches. Where the table's format has a row-level
    MERGE it is used, unless ``row_level`` says otherwise. A plain table, or one bucketed by other
    keys, is written anew; ``bucket_table`` changes that.
    """
    spark = source.sparkSession
    settle(spark, table)
    if not spark.catalog.tableExists(table):
        if kind in ("update", "consume"):
            return
        if kind == "groups":
            fresh = source
        elif kind == "later":
            fresh = upsert.upsert_later(source.limit(0), source, keys, order[0])
        else:
            fresh = upsert.one_per_key(source, keys, order)
        _write_bucketed(fresh, table, keys, buckets)
        return
    if row_level is None:
        row_level = has_row_level_merge(spark, table)
    if row_level and kind not in ("groups", "later", "consume"):
        _row_level_merge(source, table, keys, kind, fields, order)
        return
    layout = _layout(spark, table)
    if layout is None or not set(layout[0]) <= set(keys):
        rewrite_table(
            spark,
            table,
            lambda target: _next_state(target, source, keys, kind, fields, order, touched),
        )
        return
    source = source.persist()
    try:
        concerned = source.select(*keys)
        if touched is not None:
            concerned = concerned.unionByName(touched.select(*keys))
        replace_parts(
            spark,
            table,
            concerned,
            lambda target: _next_state(target, source, keys, kind, fields, order, touched),
        )
    finally:
        source.unpersist()


def _next_state(target, source, keys, kind, fields, order, touched):
    if kind == "replace":
        return upsert.upsert_replace(target, source, keys, order)
    if kind == "groups":
        return upsert.replace_groups(target, source, keys, touched)
    if kind == "set":
        return upsert.upsert_set(target, source, keys, fields, order)
    if kind == "insert":
        return upsert.insert_only(target, source, keys, order or keys)
    if kind == "update":
        return upsert.update_only(target, source, keys, fields, order)
    if kind == "consume":
        return upsert.consume(target, source, keys)
    if kind == "later":
        return upsert.upsert_later(target, source, keys, order[0])
    raise ValueError(f"unknown merge kind: {kind}")


def _row_level_merge(source, table, keys, kind, fields, order):
    source = upsert.one_per_key(source, keys, order)
    condition = None
    for key in keys:
        match = F.expr(f"{table}.{key} = source.{key}")
        condition = match if condition is None else condition & match
    merge = source.alias("source").mergeInto(table, condition)
    if kind == "replace":
        merge = merge.whenMatched().updateAll()
    elif kind in ("set", "update"):
        merge = merge.whenMatched().update({f: F.col(f"source.{f}") for f in fields})
    if kind != "update":
        merge = merge.whenNotMatched().insertAll()
    merge.merge()
