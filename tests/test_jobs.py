"""Jobs over catalog tables: first run, second run, and what they must leave alone."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hubbub.operators import ordering, stats
from hubbub.plans import jobs
from hubbub.plans.sample_views import AS_OF, Views
from hubbub.sources import collections, documents, sinks
from hubbub.streaming import refresh
from hubbub.streaming import topics as stream
from hubbub.streaming.changelog import ChangeLog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    v = Views(spark, SF_DIR)
    for name in ("contents", "engagements", "users", "accounts", "feeditems", "contentinfo", "topics"):
        sinks.reload_table(getattr(v, name), name)
    sinks.reload_table(v.filtering.withColumn("message_en", F.lit("two words")), "contentfiltering")
    sinks.reload_table(v.credentials.withColumn("pad", F.lit(None).cast("int")).drop("pad"), "credentialfeatures")
    return v


def rows(spark, table):
    return sorted(map(repr, spark.table(table).collect()))


def test_statistics_jobs_repeat(spark, tables):
    for run in (jobs.content_stats_job, jobs.creator_stats_job, jobs.hashtag_stats_job,
                jobs.user_stats_job, jobs.user_engagement_job):
        run(spark, AS_OF)
    names = ("content_stats", "creator_stats", "hashtag_stats", "hashtag_contributions", "user_stats",
             "user_hashtag_summary", "user_engagement_stats")
    before = {name: rows(spark, name) for name in names}
    assert all(before.values())
    for run in (jobs.content_stats_job, jobs.creator_stats_job, jobs.hashtag_stats_job,
                jobs.user_stats_job, jobs.user_engagement_job):
        run(spark, AS_OF)
    assert {name: rows(spark, name) for name in names} == before


def test_rewrite_stopped_between_drop_and_rename(spark, tables):
    users = spark.table("users").select("user_id", "display_id")
    sinks.reload_table(users, "half__next")
    assert not spark.catalog.tableExists("half")
    more = spark.createDataFrame([(10**9, "new")], "user_id bigint, display_id string")
    sinks.merge_rows(more, "half", ["user_id"])
    assert spark.table("half").count() == users.count() + 1


def test_merge_kinds_on_tables(spark, tables):
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    for kind, expected in (("replace", {1: "a", 2: "B", 3: "C"}), ("set", {1: "a", 2: "B", 3: "C"}),
                           ("insert", {1: "a", 2: "b", 3: "C"}), ("update", {1: "a", 2: "B"})):
        sinks.merge_rows(new, f"never_{kind}", ["k"], kind, ["v"])
        assert spark.catalog.tableExists(f"never_{kind}") == (kind != "update")
        sinks.reload_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), f"kind_{kind}")
        sinks.merge_rows(new, f"kind_{kind}", ["k"], kind, ["v"])
        assert {r["k"]: r["v"] for r in spark.table(f"kind_{kind}").collect()} == expected


def test_content_stats_purges(spark, tables):
    jobs.content_stats_job(spark, AS_OF, target="aging")
    jobs.content_stats_job(spark, AS_OF + timedelta(days=400), target="aging")
    assert spark.table("aging").count() == 0


def test_feed_performance_appends(spark, tables):
    for _ in range(2):
        jobs.feed_performance_job(spark, AS_OF)
    assert spark.table("feed_performances").count() == 2


def test_model_jobs(spark, tables):
    jobs.content_stats_job(spark, AS_OF)
    jobs.creator_stats_job(spark, AS_OF)
    countries = spark.createDataFrame([(c,) for c in ("c1", "c2", "zz")], "account string")
    trained = spark.table("accounts").select(F.lower("country_code")).first()[0]
    jobs.country_models_job(spark, AS_OF, countries, base=trained)
    fitted = {r["account"]: r for r in spark.table("country_models").collect()}
    assert fitted["zz"]["coefficients"] == fitted[trained]["coefficients"]
    jobs.account_models_job(spark, AS_OF)
    assert spark.table("account_models").count() > 0


def test_boosted_model_jobs(spark, tables):
    jobs.content_stats_job(spark, AS_OF)
    jobs.creator_stats_job(spark, AS_OF)
    trained = spark.table("accounts").select(F.lower("country_code")).first()[0]
    countries = spark.createDataFrame([(c,) for c in ("c1", "zz")], "account string")
    for _ in range(2):
        jobs.country_models_job(spark, AS_OF, countries, target="country_trees", base=trained, trees={"trees": 2, "depth": 2})
    fitted = {r["account"]: r for r in sinks.read_table(spark, "country_trees").collect()}
    assert fitted["zz"]["trees"] == fitted[trained]["trees"] and fitted["zz"]["model"] == "boosted"
    assert {t["tree"] for t in fitted[trained]["trees"]} >= {0, 1}


def test_suggestion_jobs(spark, tables):
    jobs.default_feed_job(spark, AS_OF)
    feed = spark.table("default_guest")
    assert feed.count() == feed.select("content_id").distinct().count() > 0
    jobs.member_recommendations_job(spark, AS_OF, k=3)
    people = spark.table("person_dict").count()
    assert 0 < spark.table("results_recommend").count() <= 3 * people
    assert spark.table("content_info").count() == spark.table("content_dict").count()
    assert {"daytime", "weekend"} <= set(spark.table("member_interactions").columns)
    jobs.member_recommendations_job(spark, AS_OF, k=2, prefix="bent_", autoencoder={"width": 64, "hidden": 8, "epochs": 2})
    scores = spark.table("bent_results_recommend")
    assert scores.count() == 2 * people and scores.where("score BETWEEN 0 AND 1").count() == 2 * people


def test_cluster_job(spark, tables):
    jobs.user_engagement_job(spark, AS_OF)
    for _ in range(2):
        jobs.user_clusters_job(spark, AS_OF, k=3)
    labels = spark.table("user_clustered")
    assert labels.count() == spark.table("user_engagement_stats").count()
    assert labels.select("user_class").distinct().count() <= 3


def test_embedding_job_fills_missing_classes(spark, tables):
    known = spark.table("contentfiltering").where("class IS NOT NULL").count()
    vectors = tables.embeddings.select(F.col("vec_id").alias("content_id"), "embedding")
    rows_with_vectors = spark.table("contentfiltering").join(vectors, "content_id", "left")
    sinks.reload_table(rows_with_vectors.withColumn("class_score", F.lit(None).cast("double")), "screening")
    jobs.embedding_topics_job(spark, tables.topic_vectors, "screening")
    done = spark.table("screening")
    assert done.where("class IS NULL").isEmpty()
    assert done.where("class_score IS NULL").count() == known


def test_topics_from_text_fill_missing_classes(spark, tables):
    stored = spark.table("contentfiltering").withColumn("class_score", F.lit(None).cast("double"))
    known = stored.where("class IS NOT NULL").count()
    sinks.reload_table(stored, "read_texts")
    jobs.train_text_vectors_job(spark, "read_texts", rank=8, buckets=512, passes=2)
    assert spark.table("text_vector_model").count() == 512
    labels = spark.createDataFrame([("fox", "the quick brown fox"), ("money", "bank market share")], "topic string, words string")
    jobs.text_topics_job(spark, labels, "read_texts")
    done = spark.table("read_texts")
    assert done.where("class IS NULL").isEmpty() and done.where("class_score IS NULL").count() == known
    assert {r[0] for r in done.where("class_score IS NOT NULL").select("class").distinct().collect()} <= {"fox", "money", "etc"}


def test_screening_cycle(spark, tables):
    assert jobs.train_one_class_job(spark, AS_OF, folds=10_000) is False
    assert jobs.train_one_class_job(spark, AS_OF) is True
    artifact = spark.table("frauddetectionmlartifacts").first()
    assert set(artifact["evaluation_report"]) >= {"accuracy", "bot_class_precision", "macro_avg_f1-score"}
    assert len(artifact["dataset"]) == spark.table("credentialfeatures").where("verified_at IS NOT NULL").count()
    jobs.predict_suspicious_job(spark, AS_OF)
    first = rows(spark, "suspiciouscredentials")
    jobs.predict_suspicious_job(spark, AS_OF + timedelta(minutes=1))
    assert rows(spark, "suspiciouscredentials") == first and first
    verified = spark.table("suspiciouscredentials").withColumns(
        {"verification_status": F.lit(True), "verified_at": F.col("created_at")})
    sinks.reload_table(verified.limit(3), "reviewed")
    before = spark.table("credentialfeatures").where("verification_status").count()
    jobs.apply_verification_job(spark, AS_OF, suspicious="reviewed")
    assert spark.table("reviewed").count() == 0
    assert spark.table("credentialfeatures").where("verification_status").count() == before + 3


def test_extraction_inserts_once(spark, tables):
    for _ in range(2):
        jobs.extract_credentials_job(spark, AS_OF, target="extracted", n=20, minimum=20)
    found = spark.table("extracted")
    assert found.count() == found.select("seen_credential").distinct().count() > 0


def test_documents_flatten(spark, tmp_path):
    document = {
        "_id": "1", "author": {"id": "a"}, "type": "short", "visibility": "publish",
        "createdAt": "2024-01-30T00:00:00Z", "updatedAt": "2024-01-30T00:00:00Z",
        "payload": {"message": "hi #x", "photo": {"contents": ["p"]}},
        "engagements": {"like": {"count": 2}}, "__v": 1,
    }
    (tmp_path / "contents.json").write_text(json.dumps(document))
    flat = collections.read_collection(spark, "contents", str(tmp_path), "json")
    row = flat.first()
    assert (row["author_id"], row["like_count"], row["comment_count"]) == ("a", 2, None)
    assert row["photos"] == ["p"] and row["message"] == "hi #x"
    for name in collections.FLAT_COLUMNS:
        empty = spark.createDataFrame([], collections.schema_of(name))
        assert collections.flatten(name, empty).isEmpty()


def test_results_as_documents(spark, tables):
    for run in (jobs.content_stats_job, jobs.creator_stats_job, jobs.hashtag_stats_job,
                jobs.user_stats_job, jobs.user_engagement_job, jobs.feed_performance_job):
        run(spark, AS_OF)
    tables_of = {"contentStats": "content_stats", "creatorStats": "creator_stats",
                 "hashtagStats": "hashtag_stats", "hashtagContributions": "hashtag_contributions",
                 "userStats": "user_stats", "userHashtagSummary": "user_hashtag_summary",
                 "userEngagementStats": "user_engagement_stats", "feedperformances": "feed_performances",
                 "credentialfeatures": "credentialfeatures"}
    for collection, table in tables_of.items():
        rows_ = spark.table(table)
        found = documents.to_documents(collection, rows_)
        assert found.columns == list(documents.LAYOUTS[collection]) and found.count() == rows_.count()
    creator = documents.to_documents("creatorStats", spark.table("creator_stats")).first()
    assert creator["summary"][0]["aggregator"]["followedScore"] == creator["aggregator"]["followedScore"]


def test_content_stats_refresh_equals_batch(spark, tables, tmp_path):
    """Three batches with a changed, a withdrawn and a new content; the statistics move with time."""
    inbox, state = str(tmp_path / "in"), str(tmp_path / "state")
    contents = tables.contents
    early = contents.where("content_id < 100").withColumn("visibility", F.lit("publish"))
    early = early.withColumn("like_count", F.lit(99).cast("bigint"))

    def run(batch):
        batch.write.mode("append").parquet(inbox)
        source = spark.readStream.schema(contents.schema).parquet(inbox)
        refresh.refresh_content_stats(source, state, "content_facts").awaitTermination()
        spark.catalog.refreshTable("content_facts")

    run(early)
    run(contents.where("content_id >= 60"))
    run(contents.where("content_id < 60"))
    for moment in (AS_OF, AS_OF + timedelta(days=9)):
        found = refresh.current_content_stats(spark, moment, "content_facts")
        expected = stats.content_stats(contents, moment)
        assert found.count() == expected.count() > 0
        assert found.select(*expected.columns).exceptAll(expected).count() == 0
    assert contents.where("content_id < 60 AND visibility = 'deleted'").count() > 0


def test_documents_job_repeats_with_fewer_items(spark, tables):
    uses = lambda rows: spark.createDataFrame(
        rows, "name string, author_id long, content_id long")
    nest = lambda rows: ordering.collect_in_parts(uses(rows), ["name"], ["author_id", "content_id"], "items", 7)
    sinks.merge_rows(nest([("a", i, i) for i in range(50)] + [("b", 1, 1)]), "nested", ["name"], "groups")
    sinks.merge_rows(nest([("a", i, i) for i in range(20)]), "nested", ["name"], "groups")
    spark.catalog.refreshTable("nested")
    items = spark.table("nested").select("name", F.explode("items").alias("i")).select("name", "i.author_id").collect()
    assert sorted(r["author_id"] for r in items if r["name"] == "a") == list(range(20))
    assert [r["author_id"] for r in items if r["name"] == "b"] == [1]


def event(key, message, category, at="2024-01-30T00:00:00Z"):
    return json.dumps({"detail": {"operationType": "insert", "fullDocument": {
        "_id": key, "payload": {"message": message}, "updatedAt": at, "category": category}}})


def test_stream_tags_each_content_once(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    words = " ".join(["the way of the world is long and it was on"] * 3)
    topics = ChangeLog(f"{root}/topics", ["slug"], spark.createDataFrame([], stream.TOPIC_SCHEMA))
    info = ChangeLog(f"{root}/info", ["content_id"], spark.createDataFrame([], stream.INFO_SCHEMA))

    def run():
        messages = stream.event_messages(stream.read_change_events(spark, str(inbox)))
        stream.topic_stream(messages, topics, info, f"{root}/state", AS_OF).awaitTermination()
        return {r["content_id"]: r for r in info.current().collect()}

    (inbox / "1.json").write_text("\n".join(
        [event("1", words, "/A/B"), event("1", words, "/A/B"), event("2", "too short", "/A"),
         json.dumps({"detail": {"fullDocument": {"title": "x"}}})]))
    first = run()
    assert set(first) == {"1", "2"} and len(first["1"]["topics"]) == 2 and first["2"]["topics"] is None
    (inbox / "2.json").write_text("\n".join([event("1", words, "/Z"), event("3", words, "/A/C")]))
    second = run()
    assert second["1"] == first["1"] and len(second["3"]["topics"]) == 2
    slugs = {r["slug"]: r for r in topics.current().collect()}
    assert set(slugs) == {"a", "b", "c"} and slugs["a"]["children_slug"] == ["b", "c"]
    assert second["3"]["topics"][0] == first["1"]["topics"][0]


def test_stream_keeps_old_events(spark, tmp_path):
    """One event per file and batch: noon, a minute before, the day before."""
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    topics = ChangeLog(f"{root}/topics", ["slug"], spark.createDataFrame([], stream.TOPIC_SCHEMA))
    info = ChangeLog(f"{root}/info", ["content_id"], spark.createDataFrame([], stream.INFO_SCHEMA))
    for i, (key, at) in enumerate([("new", "2024-01-30T12:00:00Z"), ("mid", "2024-01-30T11:59:00Z"), ("old", "2024-01-29T08:00:00Z")]):
        (inbox / f"{i}.json").write_text(event(key, "some words", "/A", at))
        messages = stream.event_messages(stream.read_change_events(spark, str(inbox), 1))
        stream.topic_stream(messages, topics, info, f"{root}/state", AS_OF).awaitTermination()
    assert {r["content_id"] for r in info.current().collect()} == {"new", "mid", "old"}
