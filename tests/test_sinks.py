"""Merges into bucketed tables: what they write, and what they leave alone."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hubbub.operators import upsert
from hubbub.sources import sinks

KINDS = {
    "replace": lambda t, s: upsert.upsert_replace(t, s, ["k"]),
    "set": lambda t, s: upsert.upsert_set(t, s, ["k"], ["v"]),
    "insert": lambda t, s: upsert.insert_only(t, s, ["k"], ["k"]),
    "update": lambda t, s: upsert.update_only(t, s, ["k"], ["v"]),
    "groups": lambda t, s: upsert.replace_groups(t, s, ["k"]),
    "consume": lambda t, s: upsert.consume(t, s, ["k"]),
}


def files(spark, table):
    """Names of the data files in each part."""
    where = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    out = {}
    for path in Path(where.removeprefix("file://").removeprefix("file:")).rglob("*.parquet"):
        out.setdefault(path.parent.name, set()).add(path.name)
    return out


def filled(spark, table, n=400, **more):
    rows = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("old "), "id").alias("v"))
    sinks.merge_rows(rows, table, ["k"], **more)
    return rows


def part_of(spark, table, key):
    return f"_bucket={spark.table(table).where(F.col('k') == key).first()['_bucket']}"


@pytest.mark.parametrize("kind", KINDS)
def test_only_touched_parts_are_written(spark, kind):
    table = f"touched_{kind}"
    old = filled(spark, table, buckets=16)
    before = files(spark, table)
    assert len(before) == 16 and all(len(names) == 1 for names in before.values())
    # Plain integers on purpose: the hash must be that of the stored type.
    source = spark.createDataFrame([(7, "new"), (8, "new")], "k int, v string")
    touched = {part_of(spark, table, k) for k in (7, 8)}
    expected = KINDS[kind](old, source).collect()
    sinks.merge_rows(source, table, ["k"], kind, ["v"], ["k"])
    after = files(spark, table)
    assert {p for p in before if before[p] != after[p]} == touched
    assert sorted(sinks.read_table(spark, table).collect()) == sorted(expected)


def test_a_key_that_is_new_goes_to_its_part(spark):
    filled(spark, "grows", 50, buckets=4)
    sinks.merge_rows(spark.createDataFrame([(1000, "x")], "k long, v string"), "grows", ["k"], "insert", order=["k"])
    assert sinks.read_table(spark, "grows").count() == 51


def test_a_part_may_become_empty(spark):
    filled(spark, "emptied", 3, buckets=64)
    for k in (0, 1, 2):
        sinks.merge_rows(spark.createDataFrame([(k,)], "k long"), "emptied", ["k"], "consume")
        assert sinks.read_table(spark, "emptied").count() == 2 - k
    sinks.merge_rows(spark.createDataFrame([(5, "x")], "k long, v string"), "emptied", ["k"])
    assert sinks.read_table(spark, "emptied").collect() == [(5, "x")]


def test_null_and_repeated_keys(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c")], "k long, v string")
    sinks.merge_rows(rows, "odd_keys", ["k"], order=["v"], buckets=4)
    assert sorted(map(repr, sinks.read_table(spark, "odd_keys").collect())) == ["Row(k=1, v='b')", "Row(k=None, v='a')"]
    again = spark.createDataFrame([(1, "z"), (1, "y")], "k long, v string")
    sinks.merge_rows(again, "odd_keys", ["k"], order=["v"])
    assert {r["k"]: r["v"] for r in sinks.read_table(spark, "odd_keys").collect()} == {None: "a", 1: "y"}


def test_an_empty_source_changes_nothing(spark):
    filled(spark, "unchanged", 20, buckets=4)
    before = files(spark, "unchanged")
    sinks.merge_rows(spark.createDataFrame([], "k long, v string"), "unchanged", ["k"])
    assert files(spark, "unchanged") == before


def test_a_new_column_reaches_all_rows(spark):
    filled(spark, "widened", 20, buckets=4)
    more = spark.createDataFrame([(3, "n", 1.5)], "k long, v string, w double")
    sinks.merge_rows(more, "widened", ["k"])
    found = {r["k"]: r["w"] for r in sinks.read_table(spark, "widened").collect()}
    assert len(found) == 20 and found[3] == 1.5 and found[4] is None
    before = files(spark, "widened")
    sinks.merge_rows(more, "widened", ["k"])
    assert sum(before[p] != names for p, names in files(spark, "widened").items()) == 1


def test_a_stop_before_parts_are_in_place(spark, monkeypatch):
    """Parts are staged, some of the target's are gone: the next merge puts the staged ones in place."""
    filled(spark, "halted", 40, buckets=4)
    monkeypatch.setattr(sinks, "_put_parts", lambda *_: None)
    sinks.merge_rows(spark.createDataFrame([(7, "new")], "k long, v string"), "halted", ["k"])
    monkeypatch.undo()
    number = int(part_of(spark, "halted", 7).split("=")[1])
    sinks._remove_parts(spark, "halted", [number])
    sinks.merge_rows(spark.createDataFrame([(8, "newer")], "k long, v string"), "halted", ["k"])
    found = {r["k"]: r["v"] for r in sinks.read_table(spark, "halted").collect()}
    assert len(found) == 40 and found[7] == "new" and found[8] == "newer" and found[9] == "old 9"


def test_unfinished_parts_are_dropped(spark):
    filled(spark, "dropped_parts", 10, buckets=4)
    spark.range(3).write.saveAsTable("dropped_parts__parts")
    sinks.settle(spark, "dropped_parts")
    assert not spark.catalog.tableExists("dropped_parts__parts")
    assert sinks.read_table(spark, "dropped_parts").count() == 10


def test_plain_tables_stay_plain_until_bucketed(spark):
    sinks.reload_table(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), "plain")
    sinks.merge_rows(spark.createDataFrame([(2, "B")], "k long, v string"), "plain", ["k"])
    assert spark.table("plain").columns == ["k", "v"]
    sinks.bucket_table(spark, "plain", ["k"], 4)
    before = files(spark, "plain")
    sinks.merge_rows(spark.createDataFrame([(1, "A")], "k long, v string"), "plain", ["k"])
    assert {r["k"]: r["v"] for r in sinks.read_table(spark, "plain").collect()} == {1: "A", 2: "B"}
    kept = part_of(spark, "plain", 2)
    assert part_of(spark, "plain", 1) == kept or files(spark, "plain")[kept] == before[kept]


def test_later_rows_win_in_any_order(spark):
    def state(k, day, v):
        return spark.createDataFrame([(k, day, v)], "k long, day string, v string").withColumn("at", F.to_timestamp("day")).drop("day")

    for rows in (state(1, "2024-01-25", "new"), state(1, "2024-01-22", "late"), state(2, "2024-01-22", "x"), state(1, "2024-01-25", "same")):
        sinks.merge_rows(rows, "by_time", ["k"], "later", order=["at"], buckets=4)
    assert {r["k"]: r["v"] for r in sinks.read_table(spark, "by_time").collect()} == {1: "same", 2: "x"}


def test_unmerged_parts_are_not_read(spark):
    filled(spark, "pruned", 40, buckets=8)
    keys = spark.createDataFrame([(7,)], "k long")
    rows = sinks.touched_parts(keys, "pruned")
    read = rows.select("_metadata.file_path").distinct().count()
    assert read == 1 and 0 < rows.count() < 40
