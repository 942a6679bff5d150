"""Streams that know what they have seen from their own state."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from hubbub.plans.sample_views import AS_OF
from hubbub.streaming import topics as stream
from hubbub.streaming.changelog import ChangeLog


def event(key, message, category="/A", at="2024-01-30T00:00:00Z"):
    return json.dumps({"detail": {"operationType": "insert", "fullDocument": {
        "_id": key, "payload": {"message": message}, "updatedAt": at, "category": category}}})


def logs(spark, root, seed=()):
    topics = ChangeLog(f"{root}/topics", ["slug"], spark.createDataFrame([], stream.TOPIC_SCHEMA))
    rows = spark.createDataFrame([(k, None, None, None, None) for k in seed], stream.INFO_SCHEMA)
    return topics, ChangeLog(f"{root}/info", ["content_id"], rows)


def run(spark, inbox, root, topics, info, files=1_000):
    messages = stream.event_messages(stream.read_change_events(spark, str(inbox), files))
    query = stream.topic_stream(messages, topics, info, f"{root}/state", AS_OF)
    query.awaitTermination()
    return query


def batch(spark, root, number):
    return {r["content_id"] for r in spark.read.parquet(f"{root}/info/batch={number}").collect()}


def test_a_batch_reads_no_older_info_rows(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    topics, info = logs(spark, root)
    (inbox / "1.json").write_text("\n".join([event("1", "one"), event("2", "two")]))
    run(spark, inbox, root, topics, info)
    assert batch(spark, root, 0) == {"1", "2"}
    for file in Path(f"{root}/info/batch=0").glob("*.parquet"):
        file.write_bytes(b"not a parquet file")
    for file in Path(f"{root}/info/batch=0").glob(".*.crc"):
        file.unlink()
    (inbox / "2.json").write_text("\n".join([event("1", "again"), event("3", "three")]))
    run(spark, inbox, root, topics, info)
    assert batch(spark, root, 1) == {"3"}
    (inbox / "3.json").write_text("\n".join([event("1", "again"), event("3", "three"), event("2", "two")]))
    run(spark, inbox, root, topics, info)
    assert batch(spark, root, 2) == set()


def test_seeded_contents_are_known(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    topics, info = logs(spark, root, seed=["1", "9"])
    (inbox / "1.json").write_text("\n".join([event("1", "one"), event("2", "two")]))
    run(spark, inbox, root, topics, info)
    (inbox / "2.json").write_text("\n".join([event("9", "nine"), event("3", "three")]))
    run(spark, inbox, root, topics, info)
    assert batch(spark, root, 0) == {"2"} and batch(spark, root, 1) == {"3"}


def test_the_earliest_event_of_a_batch_counts(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    words = " ".join(["the way of the world is long and it was on"] * 3)
    topics, info = logs(spark, root)
    (inbox / "1.json").write_text("\n".join([
        event("1", words, "/Late", "2024-01-30T02:00:00Z"), event("1", words, "/Early", "2024-01-30T01:00:00Z"),
        event(None, words, "/Nobody")]))
    run(spark, inbox, root, topics, info)
    assert {r["slug"] for r in topics.current().collect()} == {"early"}


def test_keys_are_kept_by_the_state_store(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    topics, info = logs(spark, root)
    for i in range(3):
        (inbox / f"{i}.json").write_text("\n".join(event(str(k), "w") for k in range(i * 2, i * 2 + 4)))
    query = run(spark, inbox, root, topics, info, files=1)
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert states[-1]["numRowsTotal"] == 8
    assert "rocksdb" in " ".join(states[-1]["customMetrics"]).lower()
    found = [batch(spark, root, i) for i in range(3)]
    assert sorted(k for keys in found for k in keys) == [str(k) for k in range(8)]


def test_state_rows_do_not_carry_texts(spark, tmp_path):
    folder = str(tmp_path / "rows")
    spark.createDataFrame([("1", "text")], "content_id string, message string").write.parquet(folder)
    source = spark.readStream.schema("content_id string, message string").parquet(folder)
    news = stream.with_news(source, "content_id", source.select("content_id").where(F.lit(False)))
    plan = news._jdf.queryExecution().analyzed().toString()
    assert plan.count("Deduplicate [content_id") == 1


def test_the_query_takes_three_batches_at_any_number_of_files(spark, monkeypatch):
    from hubbub.plans import queries_streaming
    from hubbub.plans.sample_views import Views
    from hubbub.session import tune

    numbers, write = set(), ChangeLog.write
    monkeypatch.setattr(ChangeLog, "write", lambda self, rows, number: (numbers.add(number), write(self, rows, number)) and None)
    views = Views(tune(spark), "/root/testdata/sf0.001")
    expected = views.documents.count()
    views._built["documents"] = views.documents.repartition(5)  # as large tables are: several files a part
    assert queries_streaming.topic_stream(views).count() == expected
    assert numbers == {0, 1, 2}
