"""Incremental statistics against the batch form over the final states."""

import random
from datetime import datetime, timedelta

import pytest

from hubbub.operators import stats
from hubbub.streaming import refresh, statistics

START = datetime(2024, 1, 1)
SCHEMA = (
    "content_id long, author_id long, type string, visibility string, message string, "
    "photos array<string>, hashtags array<string>, like_count long, comment_count long, recast_count long, "
    "quote_count long, version int, created_at timestamp_ntz, updated_at timestamp_ntz, deleted boolean"
)


def state(rng, key, at):
    tag = rng.choice(["#a", "#b #c", "no tags", "#a #a", None])
    return (
        key, rng.randrange(3), rng.choice(["short", "blog"]), rng.choice(["publish"] * 4 + ["hidden"]), tag, None,
        rng.choice([None, [], ["x"], ["x", "y"]]), rng.choice([None, rng.randrange(9)]), rng.randrange(9),
        rng.randrange(9), rng.randrange(9), rng.choice([None, 1, 2, 3]), START + timedelta(hours=rng.randrange(500)),
        at, rng.random() < 0.1,
    )


def history(seed, contents=25, states=6):
    """States with distinct times per content, in an order that has nothing to do with time."""
    rng = random.Random(seed)
    rows = []
    for key in range(contents):
        for at in rng.sample(range(600), states):
            rows.append(state(rng, key, START + timedelta(hours=at)))
    rng.shuffle(rows)
    return rows


def final(rows):
    last = {}
    for r in rows:
        if r[0] not in last or r[-2] > last[r[0]][-2]:
            last[r[0]] = r
    return [r for r in last.values() if not r[-1]]


class Feed:
    def __init__(self, spark, folder, prefix):
        self.spark, self.folder, self.prefix = spark, folder, prefix

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/in")
        statistics.refresh_statistics(stream, f"{self.folder}/state", self.prefix, buckets=3).awaitTermination()


def people(spark):
    users = spark.createDataFrame(
        [(i, i, f"u{i}", "publish", START, 5, 6) for i in range(3)],
        "user_id long, owner_account long, display_id string, visibility string, created_at timestamp_ntz, "
        "followed_count long, follower_count long")
    accounts = spark.createDataFrame([(i, "C", "X") for i in range(3)], "account_id long, country_code string, continent_code string")
    return users, accounts


def plain(df):
    return sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(*sorted(df.columns)).collect())


def compare(spark, prefix, rows, as_of, days):
    contents = spark.createDataFrame(final(rows), SCHEMA)
    users, accounts = people(spark)
    assert plain(statistics.current_creator_stats(spark, users, accounts, as_of, days, prefix)) == plain(
        stats.creator_stats(contents, users, accounts, as_of, days))
    assert plain(statistics.current_hashtag_stats(spark, as_of, days, prefix)) == plain(
        stats.hashtag_stats(contents, as_of, days))
    assert plain(statistics.current_user_stats(spark, users, as_of, days, prefix)) == plain(
        stats.user_stats(contents, users, as_of, days))


def test_any_order_of_states_gives_the_batch_result(spark, tmp_path):
    """Changes, moves between authors and days, deletions and late events; the window cuts a day."""
    rows = history(1)
    feed = Feed(spark, str(tmp_path), "order_")
    for part in range(3):
        feed.add(rows[part * 50 : part * 50 + 50])
        feed.run()
        seen = rows[: part * 50 + 50]
        compare(spark, "order_", seen, START + timedelta(days=22, hours=7, minutes=30), 11.3)
    compare(spark, "order_", rows, START + timedelta(days=20), 9)


def test_a_batch_repeated_after_a_failure(spark, tmp_path, monkeypatch):
    rows = history(2, contents=12)
    feed = Feed(spark, str(tmp_path), "again_")
    feed.add(rows[:36])
    feed.run()
    feed.add(rows[36:])
    done = []
    real_apply, real_merge = statistics.apply_changes, statistics.merge_rows

    def failing_apply(*args):
        real_apply(*args)
        done.append(args[0].name)
        if len(done) == 2:
            raise RuntimeError("stopped between two tables")

    monkeypatch.setattr(statistics, "apply_changes", failing_apply)
    with pytest.raises(Exception, match="stopped"):
        feed.run()
    monkeypatch.setattr(statistics, "apply_changes", real_apply)

    def failing_merge(*args, **named):
        if args[2] == ["content_id"] and args[3] == "later":
            raise RuntimeError("stopped before the states")
        return real_merge(*args, **named)

    monkeypatch.setattr(statistics, "merge_rows", failing_merge)
    with pytest.raises(Exception, match="stopped"):
        feed.run()
    monkeypatch.undo()
    feed.run()
    compare(spark, "again_", rows, START + timedelta(days=25), 14)


def test_late_event_after_newer_state_and_after_deletion(spark, tmp_path):
    """A newer state stays after an older one comes, and so does a deletion; content statistics."""
    inbox, target = str(tmp_path / "in"), "late_facts"
    base = list(state(random.Random(3), 1, START))
    base[3], base[4], base[-1] = "publish", "hello", False

    def at(day, likes, deleted=False):
        row = list(base)
        row[7], row[-2], row[-1] = likes, START + timedelta(days=day), deleted
        return tuple(row)

    def run(row):
        spark.createDataFrame([row], SCHEMA).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        refresh.refresh_content_stats(stream, str(tmp_path / "state"), target, 2).awaitTermination()
        now = refresh.current_content_stats(spark, START + timedelta(days=28), target, days=60)
        return [r["like_count"] for r in now.collect()]

    assert run(at(25, 9)) == [9]
    assert run(at(22, 3)) == [9]
    assert run(at(26, 9, deleted=True)) == []
    assert run(at(23, 4)) == []
    assert run(at(27, 5)) == [5]


def test_rows_without_id_or_time(spark, tmp_path):
    rows = history(4, contents=4)
    odd = [(None, *rows[0][1:]), (*rows[0][:-2], None, False)]
    feed = Feed(spark, str(tmp_path), "odd_")
    feed.add(rows + odd)
    feed.run()
    compare(spark, "odd_", rows, START + timedelta(days=25), 14)
