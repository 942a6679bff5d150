"""Registered queries: table writes and incremental statistics, through catalog tables.

Each run makes tables of its own name; what it returns is read back from them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hubbub.plans import queries_stats as batch
from hubbub.plans.registry import ORACLES, query
from hubbub.plans.sample_views import AS_OF
from hubbub.session import shared_dir
from hubbub.sources.sinks import merge_rows, read_table
from hubbub.streaming import refresh, statistics

#: Parts of the tables made here.
BUCKETS = 8


def _merged(v, kind, source=None, order=()):
    """The target after a merge of the source, both in parts by a hash of the key."""
    table = f"merged_{kind}_{uuid.uuid4().hex}"
    keys = ["user_id"]
    merge_rows(batch._target(v), table, keys, buckets=BUCKETS)
    merge_rows(batch._source(v) if source is None else source, table, keys, kind, ["followed_count"], order)
    return read_table(v.spark, table)


@query(ORACLES["upsert_replace"])
def sink_replace(v):
    return _merged(v, "replace")


@query(ORACLES["upsert_set"])
def sink_set(v):
    return _merged(v, "set")


@query(ORACLES["insert_only"])
def sink_insert(v):
    twice = batch._source(v).unionByName(batch._source(v).withColumn("display_id", F.lit("zz")))
    return _merged(v, "insert", twice, ["display_id"])


@query(ORACLES["update_only"])
def sink_update(v):
    return _merged(v, "update")


@query(ORACLES["consume"])
def sink_consume(v):
    return _merged(v, "consume")


def _changes(v):
    """Three batches of content states that end in ``contents``.

    Older states of some contents come first and are replaced later; older states of others come
    after the newer ones and must change nothing; some contents are deleted in the end.
    """
    known = v.contents.withColumn("deleted", F.lit(False))
    older = known.withColumns(
        {
            "updated_at": F.expr("updated_at - INTERVAL '3' DAY"),
            "created_at": F.expr("created_at + INTERVAL '1' HOUR"),
            "author_id": F.col("author_id") + F.col("content_id") % 2,
            "type": F.lit("blog"),
            "visibility": F.lit("publish"),
            "message": F.concat_ws(" ", "message", F.lit("#once")),
            "like_count": F.lit(99).cast("bigint"),
            "version": F.lit(5),
        }
    )
    passing = known.where("content_id % 5 = 0").withColumn("content_id", F.col("content_id") + 10**12)
    gone = passing.withColumns(
        {"deleted": F.lit(True), "updated_at": F.expr("updated_at + INTERVAL '1' HOUR")}
    )
    even, odd = "content_id % 2 = 0", "content_id % 2 = 1"
    return [
        older.where(even).unionByName(passing),
        known.where(odd).unionByName(known.where("content_id % 4 = 0")),
        known.where("content_id % 4 = 2").unionByName(older.where(odd)).unionByName(gone),
    ]


def _drained(v, run):
    """``run(stream, checkpoint)`` after each of the three batches has come in."""
    folder = f"{shared_dir(v.spark)}/refresh-{uuid.uuid4().hex}"
    for rows in _changes(v):
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = v.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        run(stream, f"{folder}/checkpoint").awaitTermination()


@query(ORACLES["content_stats"])
def content_stats_refreshed(v):
    target = f"content_facts_{uuid.uuid4().hex}"
    _drained(v, lambda stream, checkpoint: refresh.refresh_content_stats(stream, checkpoint, target, BUCKETS))
    return refresh.current_content_stats(v.spark, AS_OF, target)


def _refreshed(v, kind):
    prefix = f"live_{uuid.uuid4().hex}_"
    _drained(v, lambda stream, checkpoint: statistics.refresh_statistics(stream, checkpoint, prefix, [kind], BUCKETS))
    return prefix


@query(ORACLES["creator_stats"])
def creator_stats_refreshed(v):
    prefix = _refreshed(v, statistics.CREATORS)
    found = statistics.current_creator_stats(v.spark, v.users, v.accounts, AS_OF, prefix=prefix)
    return found.drop("summary")


@query(ORACLES["hashtag_stats"])
def hashtag_stats_refreshed(v):
    return statistics.current_hashtag_stats(v.spark, AS_OF, prefix=_refreshed(v, statistics.HASHTAGS))


@query(ORACLES["user_stats"])
def user_stats_refreshed(v):
    return statistics.current_user_stats(v.spark, v.users, AS_OF, prefix=_refreshed(v, statistics.USERS))
