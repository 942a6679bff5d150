"""Hand-computed results, edge cases and invariants on small frames."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hubbub.functions import text
from hubbub.functions.scores import Weights, age_score, engagement_score
from hubbub.operators import (
    clusters,
    engagement,
    feed,
    features,
    fraud,
    models,
    ordering,
    recommend,
    stats,
    topics,
    upsert,
)

NOW = datetime(2024, 1, 31)
HOUR = timedelta(hours=1)


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    row = tuple(v for _, v in values.values())
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


def clean(spark, function, value):
    return one(spark, function(F.col("m")), m=("string", value))


def test_age_halves_every_half_life(spark):
    now = F.lit(NOW)
    for hours, expected in ((0, 1.0), (24, 0.5), (48, 0.25)):
        got = one(spark, age_score(F.col("t"), now), t=("timestamp", NOW - hours * HOUR))
        assert got == pytest.approx(expected)
    got = one(spark, age_score(F.col("t"), now, 12), t=("timestamp", NOW - 24 * HOUR))
    assert got == pytest.approx(0.25)


def test_engagement_skips_missing_counts(spark):
    score = engagement_score(F.col("a"), F.col("b"), F.col("c"), F.col("d"), Weights(1, 2, 3, 4))
    values = {k: ("bigint", v) for k, v in zip("abcd", (1, None, 2, 5))}
    assert one(spark, score, **values) == 27.0


CONTENT = (
    "content_id string, author_id string, type string, visibility string, message string, "
    "photos array<string>, like_count bigint, comment_count bigint, recast_count bigint, "
    "quote_count bigint, hashtags array<string>, created_at timestamp, updated_at timestamp"
)
USER = (
    "user_id string, owner_account string, display_id string, visibility string, "
    "created_at timestamp, followed_count bigint, follower_count bigint"
)
ACCOUNT = "account_id string, country_code string, continent_code string"


def content(key, author="a", kind="short", visibility="publish", message="hi", photos=None,
            counts=(1, 2, 3, 4), tags=None, created=HOUR, updated=24 * HOUR):
    return (key, author, kind, visibility, message, photos, *counts, tags, NOW - created,
            NOW - updated)


def test_content_stats(spark):
    rows = [
        content("1", message=None, photos=None),
        content("2", message="añb😀", photos=["p", "q"], counts=(None, 1, 1, 1)),
        content("3", visibility="deleted"),
        content("4", created=timedelta(days=31)),
        content("5", created=timedelta(days=30)),
    ]
    found = {r["content_id"]: r for r in stats.content_stats(
        spark.createDataFrame(rows, CONTENT), NOW).collect()}
    assert set(found) == {"1", "2", "5"}
    assert (found["1"]["photo_count"], found["1"]["character_length"]) == (0, 1)
    assert (found["2"]["photo_count"], found["2"]["character_length"]) == (2, 4)
    assert found["1"]["score"] == pytest.approx(11 * 0.5)
    assert found["2"]["score"] == pytest.approx(4 * 0.5)


def test_creator_stats(spark):
    rows = [
        content("1", counts=(1, 0, 0, 0)),
        content("2", counts=(0, 2, 0, 0), updated=48 * HOUR),
        content("3", kind="blog", counts=(0, 0, 0, 3), updated=48 * HOUR),
        content("4", author="hidden"),
        content("5", author="homeless"),
        content("6", author="unknown"),
    ]
    users = [("a", "acc", "A", "publish", NOW, 200, 7), ("hidden", "acc", "H", "private", NOW, 1, 1),
             ("homeless", "none", "N", "publish", NOW, 1, 1)]
    found = stats.creator_stats(
        spark.createDataFrame(rows, CONTENT), spark.createDataFrame(users, USER),
        spark.createDataFrame([("acc", "TH", "AS")], ACCOUNT), NOW).collect()
    assert [r["creator_id"] for r in found] == ["a"]
    row = found[0]
    assert row["content_count"] == 3 and row["creator_commented_count"] == 2
    assert row["engagement_score"] == 7.0 and row["age_score"] == pytest.approx(0.5)
    assert row["score"] == pytest.approx(7 / 3 * 0.5 + 2.0 + 1.0)
    blog, short = row["summary"]
    assert (blog["type"], short["type"]) == ("blog", "short")
    assert blog["score"] == pytest.approx(1 / 3 * (5 / 8) * 0.25 + 2.0)
    assert short["score"] == pytest.approx(2 / 3 * (5 / 8) * 0.5 + 2.0)


def test_hashtags_count_repeats_and_lower(spark):
    rows = [content("1", message="#A x #a #b_1"), content("2", author="b", message="##a"),
            content("3", message="none"), content("4", message=None)]
    found = {r["name"]: r for r in stats.hashtag_stats(
        spark.createDataFrame(rows, CONTENT), NOW).collect()}
    assert set(found) == {"a", "b_1"}
    assert found["a"]["hashtag_count"] == 3 and found["a"]["contributor_count"] == 2
    assert found["a"]["score"] == pytest.approx(2 / 3 * 31 * 0.5)


@pytest.mark.parametrize("per_row", [1, 3, 1000])
def test_nested_documents_keep_every_item(spark, per_row):
    rows = [content(str(i), author=str(i % 7), message="#hot" + (" #cold" if i == 3 else ""))
            for i in range(200)]
    nested = stats.hashtag_documents(
        spark.createDataFrame(rows, CONTENT), NOW, items_per_row=per_row).collect()
    hot = [c for r in nested if r["name"] == "hot" for c in r["contributions"]]
    assert sorted(int(c["content_id"]) for c in hot) == list(range(200))
    assert len([r for r in nested if r["name"] == "cold"]) == 1
    if per_row == 1000:
        assert len(nested) == 2


def test_user_stats_keeps_unknown_users(spark):
    rows = [content("1", tags=["x"]), content("2", tags=["x"], kind="blog"), content("3"),
            content("4", author="ghost")]
    frame = spark.createDataFrame(rows, CONTENT)
    users = spark.createDataFrame([("a", "acc", "A", "publish", NOW, 1, 1)], USER)
    totals = {r["user_id"]: r for r in stats.user_stats(frame, users, NOW).collect()}
    assert totals["a"]["user_content_count"] == 3 and totals["ghost"]["owner_account"] is None
    detail = stats.user_documents(frame, NOW).where("author_id = 'a'").first()["hashtag_summary"]
    assert sorted((str(d["hashtags"]), len(d["content_summary"])) for d in detail) == [
        ("None", 1), ("['x']", 2)]


def test_topic_maps(spark):
    engaged = [("u", "like", "content", "1"), ("u", "like", "content", "2"),
               ("u", "report", "content", "1"), ("u", "like", "user", "1"),
               ("w", "strange", "content", "1")]
    info = [("1", ["t", "s"]), ("2", ["t"]), ("3", None)]
    counts = engagement.user_topic_engagement(
        spark.createDataFrame(engaged, "user_id string, type string, target_ref string, content_id string"),
        spark.createDataFrame(info, "content_id string, topics array<string>"))
    maps = engagement.user_topic_maps(counts, NOW).collect()
    assert len(maps) == 1
    assert maps[0]["like_topics"] == {"t": 2, "s": 1} and maps[0]["report_topics"] == {"t": 1, "s": 1}
    assert maps[0]["quote_topics"] == {} and maps[0]["timestamp"] == "01/31/2024, 00:00:00"


def feed_frames(spark, items, engaged, users):
    return (
        spark.createDataFrame(items, "id string, viewer string, content_id string, score double, "
                              "source string, updated_at timestamp"),
        spark.createDataFrame(engaged, "id string, user_id string, type string, target_ref string, "
                              "content_id string, updated_at timestamp"),
        spark.createDataFrame(users, USER),
    )


def test_feed_performance(spark):
    t = NOW - HOUR
    items = [("1", "acc", "c", 1.0, "personal", t), ("2", "acc", "d", 1.0, "personal", t),
             ("3", "acc", "e", 0.0, "global", t), ("4", None, "c", 2.0, "global", t)]
    engaged = [("1", "u", "like", "content", "c", t), ("2", "u", "report", "content", "c", t),
               ("3", "nobody", "quote", "content", "c", t)]
    users = [("u", "acc", "U", "publish", NOW, 1, 1)]
    row = feed.feed_performance(*feed_frames(spark, items, engaged, users), NOW).first()
    # item 1 meets two engagements, item 2 none; the null viewer meets the unknown user
    assert row["personal_percent"] == pytest.approx(33.33)
    assert row["global_percent"] == 100.0 and row["overall_percent"] == 50.0


def test_feed_performance_without_rows(spark):
    row = feed.feed_performance(*feed_frames(spark, [], [], []), NOW).first()
    assert (row["personal_percent"], row["global_percent"], row["overall_percent"]) == (0, 0, 0)


def test_weighted_label(spark):
    rows = spark.createDataFrame(
        [("th", "1", 3, 0, 1, 0), ("th", "2", 1, 0, 0, 0)],
        "country_code string, content_id string, like bigint, comment bigint, recast bigint, quote bigint")
    label = {r["content_id"]: r["label"] for r in features.weighted_label(rows, "country_code").collect()}
    total = 4 + 1 + 1 + 1
    assert label["1"] == pytest.approx(3 * (1 - 4 / total) + 1 * (1 - 1 / total))
    assert label["2"] == pytest.approx(1 - 4 / total)


def test_ridge_matches_numpy(spark):
    generator = np.random.default_rng(3)
    x = generator.normal(size=(200, 3)) * [1, 50, 0.1] + [0, 1000, 5]
    x[:, 2] = 7.0  # a constant feature gets no weight
    y = x @ [2.0, -0.01, 3.0] + generator.normal(size=200)
    frame = spark.createDataFrame(
        [("k", *map(float, row), float(v)) for row, v in zip(x, y)] + [("one", 1.0, 2.0, 3.0, 4.0)],
        "key string, a double, b double, c double, y double")
    rows = {r["account"]: r for r in models.fit_per_key(
        frame, "key", ["a", "b", "c"], "y", NOW, penalty=0.1).collect()}
    z = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0)
    expected = np.linalg.solve(z.T @ z / 200 + 0.1 * np.eye(2), z.T @ (y - y.mean()) / 200)
    expected = expected / x[:, :2].std(0)
    assert rows["k"]["coefficients"][:2] == pytest.approx(expected, rel=1e-6)
    assert rows["k"]["coefficients"][2] == 0.0
    assert rows["k"]["intercept"] == pytest.approx(y.mean() - expected @ x[:, :2].mean(0), rel=1e-6)
    assert rows["one"]["coefficients"] == [0, 0, 0] and rows["one"]["intercept"] == 4.0


def test_fallback_without_base(spark):
    frame = spark.createDataFrame([("us", "m", 1.0)], "account string, model string, w double")
    keys = spark.createDataFrame([("us",), ("fr",)], "account string")
    assert models.base_model_fallback(frame, keys, "us").count() == 2
    assert models.base_model_fallback(frame, keys, "th").count() == 1


def test_popularity_of_equal_strengths_is_zero(spark):
    pairs = spark.createDataFrame([("p", "1", NOW, 1.0), ("p", "2", NOW, 1.0)],
                                  "person_id string, content_id string, timestamp timestamp, event_strength double")
    listed = spark.createDataFrame([("1", "x", "us", "as", "en", "a"), ("2", "y", None, None, "en", "a")],
                                   "content_id string, title string, country_code string, continent_code string, "
                                   "language string, author string")
    seen = recommend.content_strength(pairs, listed)
    assert {r["score"] for r in recommend.popularity(seen, "language").collect()} == {0.0}
    assert recommend.popularity(seen, "country_code").count() == 1
    best = {r["content_id"]: r["model_key"] for r in recommend.default_feed(seen).collect()}
    assert best == {"1": "country_code", "2": "language"}


def test_interaction_strengths(spark):
    rows = [("u", "1", "like", NOW), ("u", "1", "quote", NOW - HOUR), ("u", "1", "report", NOW),
            ("u", "1", "odd", NOW), ("u", "2", "like", NOW - timedelta(days=130)), ("u", "9", "like", NOW)]
    engaged = spark.createDataFrame(rows, "user_id string, content_id string, type string, created_at timestamp")
    listed = spark.createDataFrame([("1",), ("2",)], "content_id string")
    plain = recommend.interactions(engaged, listed, NOW).collect()
    assert [(r["content_id"], r["event_strength"]) for r in plain] == [("1", 3.5)]
    as_like = recommend.interactions(engaged, listed, NOW, unknown_as="like").first()
    assert as_like["event_strength"] == 4.5


def test_dense_ids_have_no_gaps(spark):
    frame = spark.createDataFrame([(f"v{i % 500}",) for i in range(2000)] + [(None,)], "k string")
    rows = ordering.dense_ids(frame, "k", "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(500))


@pytest.mark.parametrize("bucket", [1, 60, 3600, 10**7])
def test_previous_time_equals_plain_lag(spark, bucket):
    """One user owns most rows; gaps skip buckets and times repeat."""
    dice = random.Random(5)
    rows = [("hot" if dice.random() < 0.7 else f"u{dice.randrange(9)}", i,
             NOW + timedelta(seconds=dice.choice([0, 1, 3000, 90_000]) * dice.randrange(40)))
            for i in range(600)]
    frame = spark.createDataFrame(rows, "who string, id int, at timestamp")
    got = {r["id"]: r["before"] for r in ordering.previous_time(
        frame, "who", "at", "id", "before", bucket).collect()}
    expected, last = {}, {}
    for who, i, at in sorted(rows, key=lambda r: (r[2], r[1])):
        expected[i] = last.get(who)
        last[who] = at
    assert got == expected


def test_reading_features_match_brute_force(spark):
    dice = random.Random(11)
    rows, at = [], NOW
    for i in range(300):
        at += timedelta(seconds=dice.randrange(1, 5000))
        stay = dice.choice([-3, 0.5, 2, 9, 40, 300])
        off = None if i % 23 == 0 else at + timedelta(seconds=stay)
        rows.append(("u", i, at, off))
    rows += [("few", 1000 + i, NOW + i * HOUR, NOW + i * HOUR + HOUR) for i in range(5)]
    rows += [("flat", 2000 + i, NOW + i * HOUR, NOW + i * HOUR + HOUR) for i in range(60)]
    items = spark.createDataFrame(rows, "seen_credential string, id int, seen_at timestamp, off_screen_at timestamp")
    found = fraud.credential_features(fraud.last_n(fraud.reading_times(items), 50, 50), NOW).collect()
    assert [r["seen_credential"] for r in found] == ["u"]  # too few rows; zero variance

    complete = [(s, o) for who, _, s, o in rows if who == "u" and o is not None]
    valid = [((o - s).total_seconds(), (s - complete[i - 1][0]).total_seconds())
             for i, (s, o) in enumerate(complete) if i > 0 and o >= s][-50:]
    x, d = (np.array(v) for v in zip(*valid))
    x, d = x[x <= np.quantile(x, 0.95)], d[d <= np.quantile(d, 0.95)]
    n, c = len(x), x - x.mean()
    skew = math.sqrt(n * (n - 1)) / (n - 2) * (c**3).mean() / (c**2).mean() ** 1.5
    kurt = ((n * n - 1) * (c**4).mean() / (c**2).mean() ** 2 - 3 * (n - 1) ** 2) / ((n - 2) * (n - 3))
    row = found[0]
    assert row["post_reading_time_abs_skew"] == pytest.approx(abs(skew))
    assert row["post_reading_time_abs_kurt"] == pytest.approx(abs(kurt))
    assert row["post_reading_time_norm_std"] == pytest.approx(x.std(ddof=1) / x.mean())
    assert row["post_reading_time_difference_norm_std"] == pytest.approx(d.std(ddof=1) / d.mean())


def test_one_class_model_matches_numpy(spark):
    names = list(fraud.CREDENTIAL_FEATURES)
    data = np.random.default_rng(2).normal(size=(80, 4)) * [3, 1, 0.5, 0.2]
    frame = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{n} double" for n in names))
    model = fraud.fit_one_class_pca(frame, NOW)
    centred = data - data.mean(0)
    axis = np.linalg.svd(centred)[2][0]
    distance = np.linalg.norm(centred - np.outer(centred @ axis, axis), axis=1)
    span = distance.max() - distance.min()
    row = model.first()
    assert row["upper_bound"] == pytest.approx(distance.max() + span * 0.1)
    assert row["lower_bound"] == pytest.approx(distance.min() - span * 0.1)
    far = frame.limit(1).withColumn(names[3], F.lit(50.0)).unionByName(frame)
    assert sorted(r["predicted"] for r in fraud.predict_one_class(far, model).collect()) == [0] * 80 + [1]


def test_no_model_predicts_nothing(spark):
    names = list(fraud.CREDENTIAL_FEATURES)
    frame = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], ", ".join(f"{n} double" for n in names))
    model = fraud.fit_one_class_pca(frame.limit(0), NOW)
    assert fraud.predict_one_class(frame, model).first()["predicted"] is None


def test_splits_are_stratified_and_repeatable(spark):
    frame = spark.createDataFrame([(i, 0 if i < 50 else 1) for i in range(80)], "id int, label int")
    counts = fraud.stratified_splits(frame, "id").groupBy("fold", "label").agg(
        F.count_if("is_train").alias("train"), F.count("*").alias("n")).collect()
    assert {(r["label"], r["train"], r["n"]) for r in counts} == {(0, 40, 50), (1, 24, 30)}
    assert len(counts) == 10


def test_report_by_hand(spark):
    frame = spark.createDataFrame([(0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 1)], "fold int, label int, predicted int")
    found = {r["metric"]: r["value"] for r in fraud.classification_report(frame).collect()}
    assert found["accuracy"] == 0.75 and found["bot_class_precision"] == 1.0
    assert found["human_class_f1-score"] == pytest.approx(0.8)
    assert found["macro_avg_recall"] == 0.75 and found["weighted_avg_support"] == 4
    none = spark.createDataFrame([(0, 1, 1)], "fold int, label int, predicted int")
    found = {r["metric"]: r["value"] for r in fraud.classification_report(none).collect()}
    assert found["bot_class_precision"] == 0.0


def test_cleaning(spark):
    assert clean(spark, text.clean_message, "Hi!! 😀 it's\nhttp://x.y/z r/news,  中文ok ") == "Hi its news ok"
    assert clean(spark, text.clean_message, "สวัสดี a") == "a"
    assert clean(spark, text.clean_message, "a-b  c\td") == "a b c d"
    assert clean(spark, text.clean_message_v2, "see www.a-b.com/x?y=1&z #Été_1 go\n\nnow") == "see gonow"
    assert clean(spark, text.clean_message_v2, "n 12 abc ☺ tail  x.y 7") == "n tail x.y 7"
    assert clean(spark, text.strip_urls, "a httpx://b c") == "a  c"
    assert clean(spark, text.strip_hashtags, "a #tag  b#c") == "a b"
    assert clean(spark, text.strip_emojis, "a©★b😀") == "ab😀"


def test_long_runs_do_not_overflow_or_stall(spark):
    for value in ("a" * 200_000, "." * 200_000, "a." * 100_000, "r/" * 100_000, "! " * 100_000,
                  "x.com&" * 50_000, "9" * 200_000):
        assert clean(spark, text.clean_message, value) is not None
        assert clean(spark, text.clean_message_v2, value) is not None


def test_language(spark):
    assert clean(spark, text.language_tag, "this is the way of the world") == "en"
    assert clean(spark, text.language_tag, "der Hund und die Katze") == "de"
    assert clean(spark, text.language_tag, "the ก") == "th"
    assert clean(spark, text.language_tag, "12345") == "n/a"
    assert clean(spark, text.language_tag, "") == "n/a"


def test_tokens_and_slugs(spark):
    assert clean(spark, text.token_count, "a  b ") == 4
    assert clean(spark, text.classifiable, " ".join("x" * 21)) is True
    assert clean(spark, text.classifiable, " ".join("x" * 20)) is False
    assert clean(spark, text.topic_slugs, "/Food & Drink/Hot  Tea") == ["food-and-drink", "hot-tea"]


def test_category_choice(spark):
    frame = spark.sql("SELECT array(named_struct('name', 'a', 'confidence', 0.9D), "
                      "named_struct('name', 'b', 'confidence', 0.1D)) AS c")
    assert frame.select(topics.chosen_category(F.col("c"))).first()[0] == "b"
    assert frame.select(topics.chosen_category(F.col("c"), True)).first()[0] == "a"


def test_taxonomy_twice_is_once(spark):
    from hubbub.streaming.topics import TOPIC_SCHEMA

    paths = spark.createDataFrame([(["a", "b", "c"], NOW), (["a", "d"], NOW - HOUR), (None, NOW)],
                                  "slugs array<string>, updated_at timestamp")
    first = topics.topic_taxonomy(paths, spark.createDataFrame([], TOPIC_SCHEMA))
    rows = {r["slug"]: r for r in first.collect()}
    assert rows["a"]["children_slug"] == ["b", "d"] and rows["a"]["parents"] == []
    assert [p["slug"] for p in rows["c"]["parents"]] == ["b"]
    assert rows["a"]["created_at"] == NOW - HOUR and rows["a"]["updated_at"] == NOW
    again = topics.topic_taxonomy(paths, first)
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_embedding_topics_edges(spark):
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0], "two words"), (2, [1.0, 0.0], "word"), (3, [0.1, 0.1], "two words"), (4, None, "two words")],
        "content_id int, embedding array<double>, message string")
    labels = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "topic string, embedding array<double>")
    found = {r["content_id"]: (r["class"], r["score"]) for r in topics.embedding_topics(vectors, labels).collect()}
    assert found == {1: ("x", 1.0), 2: ("etc", 0.0), 3: ("etc", 0.0), 4: ("etc", 0.0)}


def test_embedding_topics_in_slices(spark, monkeypatch):
    dice = np.random.default_rng(3)
    labels = [(f"t{i:04}", [float(x) for x in dice.normal(size=6)]) for i in range(5000)]
    rows = [(i, [float(x) for x in dice.normal(size=6)]) for i in range(50)]
    vectors = spark.createDataFrame(rows, "content_id int, embedding array<double>")
    named = spark.createDataFrame(labels, "topic string, embedding array<double>")
    expected = {i: labels[int(np.argmax([np.dot(v, w) for _, w in labels]))][0] for i, v in rows}
    for size in (700, 4096, 10_000):
        monkeypatch.setattr(topics, "LABELS_AT_ONCE", size)
        found = topics.embedding_topics(vectors, named).collect()
        assert {r["content_id"]: r["class"] for r in found} == expected


def test_thousands_of_topics(spark):
    counts = spark.createDataFrame([("u", "like", "t4999", 3), ("v", "report", "x", 1)], "user_id string, type string, topic_id string, count long")
    taxonomy = spark.range(5000).selectExpr("concat('t', id) AS topic_id")
    places = clusters.topic_places(counts, taxonomy)
    vectors = clusters.user_topic_vectors(counts, places)
    found = {r["user_id"]: r["features"] for r in vectors.collect()}
    assert found["u"].size == 5 * 5001 and found["u"].values.tolist() == [3.0]
    cells = clusters.user_topic_matrix(vectors, places)
    assert cells.count() == 2 * 5 * 5001
    assert {r["cell"] for r in cells.where("count > 0").collect()} == {"like.t4999", "report.x"}


def test_ridge_far_from_zero(spark):
    rows = [("a", 1e8 + i / 100, i / 100) for i in range(1000)]
    frame = spark.createDataFrame(rows, "account string, x double, y double")
    fitted = models.fit_per_key(frame, "account", ["x"], "y", NOW).first()
    assert fitted["coefficients"][0] == pytest.approx(1 / 1.1, rel=1e-3)


def test_write_invariants(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    source = spark.createDataFrame([(2, "B", 20), (3, "C", 30)], "k int, v string, n int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    once = upsert.upsert_replace(target, source, ["k"])
    assert rows(once) == [(1, "a", 1), (2, "B", 20), (3, "C", 30)]
    assert rows(upsert.upsert_replace(once, source, ["k"])) == rows(once)
    assert rows(upsert.upsert_set(target, source, ["k"], ["n"])) == [(1, "a", 1), (2, "b", 20), (3, None, 30)]
    assert rows(upsert.insert_only(target, source, ["k"], ["v"])) == [(1, "a", 1), (2, "b", 2), (3, "C", 30)]
    assert rows(upsert.update_only(target, source, ["k"], ["n"])) == [(1, "a", 1), (2, "b", 20)]
    assert rows(upsert.consume(target, source, ["k"])) == [(1, "a", 1)]


def test_verification_consumes_matched_rows(spark):
    keys = "seen_credential string, first_seen_at timestamp, last_seen_at timestamp"
    stored = spark.createDataFrame([("u", NOW, NOW, None, None, NOW)],
                                   f"{keys}, verification_status boolean, verified_at timestamp, updated_at timestamp")
    waiting = spark.createDataFrame(
        [("1", "u", NOW, NOW, True, NOW), ("2", "w", NOW, NOW, True, NOW), ("3", "u", NOW, NOW, None, None)],
        f"id string, {keys}, verification_status boolean, verified_at timestamp")
    updated, left = fraud.apply_verification(stored, waiting, NOW + HOUR)
    row = updated.first()
    assert row["verification_status"] is True and row["updated_at"] == NOW + HOUR
    assert sorted(r["id"] for r in left.collect()) == ["2", "3"]
    assert [r["id"] for r in fraud.apply_verification(stored, waiting, NOW, True)[1].collect()] == ["3"]


def test_cooldown(spark):
    keys = "seen_credential string, first_seen_at timestamp, last_seen_at timestamp"
    found = spark.createDataFrame([(u, NOW, NOW, p) for u, p in (("a", 0), ("b", 0), ("c", 0), ("d", 1))],
                                  f"{keys}, predicted int")
    verified = spark.createDataFrame([("a", NOW - HOUR), ("b", NOW - HOUR / 2)],
                                     "seen_credential string, verified_at timestamp")
    users = {r["seen_credential"] for r in fraud.suspicious_users(found, verified, NOW).collect()}
    assert users == {"a", "c"}
