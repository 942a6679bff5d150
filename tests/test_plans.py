"""Plans: filters and columns reach the scan, no nested loops, small things are shuffled."""

import os

import pytest

from hubbub.plans import catalog
from hubbub.session import saved, scratch, shared_dir

SF_DIR = "/root/testdata/sf0.001"
LAZY = (
    "articles", "content_features", "creator_stats", "credential_features", "embedding_topics",
    "feed_performance", "hashtag_documents", "hashtag_stats", "interactions", "last_n",
    "min_interaction_users", "reading_times", "tag_messages", "topic_taxonomy", "upsert_set",
    "user_documents", "user_stats", "user_topic_engagement", "user_topic_maps",
)


def plan(spark, name, mode="formatted"):
    frame = catalog.queries()[name](spark, SF_DIR)
    explain = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return frame._jdf.queryExecution().explainString(explain)


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_time_range_is_pushed(spark):
    for name in ("country_engagement", "interactions", "feed_performance"):
        assert "GreaterThanOrEqual(ts," in plan(spark, name)


def test_columns_are_pruned(spark):
    scans = [line for line in plan(spark, "country_engagement").splitlines() if "ReadSchema" in line]
    assert scans and not any("props" in s or "value" in s or "c_acctbal" in s for s in scans)


def test_last_rows_are_limited_before_the_shuffle(spark):
    for name in ("last_n", "latest_unverified", "insert_only"):
        assert plan(spark, name).count("WindowGroupLimit") >= 2


def test_texts_are_not_regrouped_by_slug(spark):
    text = plan(spark, "content_topics")
    grouped = [line for line in text.splitlines() if "collect_list" in line]
    assert grouped and not any("translated_en" in line for line in grouped)


def test_engagements_are_counted_before_topics(spark):
    scans = plan(spark, "user_topic_engagement", "simple")
    assert scans.count("HashAggregate") >= 4


def test_saved_rows_use_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    again = saved(spark.range(5))
    assert again.count() == 5 and named in again.inputFiles()[0]


def test_scratch_removes_saved_rows(spark):
    with scratch(spark):
        path = saved(spark.range(5)).inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(path)
