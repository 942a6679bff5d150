"""Text vectors against numpy's decomposition, and topics from message text alone."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hubbub.operators import topics, vectors

THEMES = {
    "sport": "match goal team player league coach stadium score striker keeper",
    "money": "bank market share price fund trader currency bond interest stock",
    "food": "recipe oven sugar butter flour kitchen dinner cook salt pepper",
}


def grams_of(message):
    words = re.findall(r"[^\W\d_]+", (message or "").lower())
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


@pytest.fixture(scope="module")
def messages(spark):
    random.seed(8)
    rows = [(i, " ".join(random.choices(text.split(), k=12)), theme) for i, (theme, text) in enumerate(list(THEMES.items()) * 60)]
    return spark.createDataFrame(rows, "id long, message string, theme string").repartition(5).persist()


def test_ngrams(spark):
    rows = [(1, "The cat, the CAT sat"), (2, "one"), (3, ""), (4, None), (5, "12 !"), (6, "dog " * 4000)]
    found = vectors.ngram_counts(spark.createDataFrame(rows, "id long, message string"), "id", "message").collect()
    assert {(r["id"], r["gram"]): r["count"] for r in found} == {(i, g): n for i, m in rows for g, n in grams_of(m).items()}


def test_equals_numpys_subspace(spark, messages):
    buckets, rank = 256, 6
    counts = vectors.bucket_counts(messages, "id", "message", buckets).persist()
    model = vectors.fit_vectors(counts, rank, buckets, passes=12).collect()
    dense, rarity = np.zeros((messages.count(), buckets)), np.zeros(buckets)
    for row in counts.collect():
        for e in row["entries"]:
            dense[row["id"], e["bucket"]] = 1 + math.log(e["count"])
    rarity = 1 + np.log((1 + len(dense)) / (1 + (dense > 0).sum(axis=0)))
    dense *= rarity
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    assert np.allclose([r["rarity"] for r in model], rarity)
    right = np.linalg.svd(dense, full_matrices=False)[2][:rank].T
    loadings = np.array([r["loadings"] for r in model])
    assert np.allclose(loadings.T @ loadings, np.eye(rank), atol=1e-8)
    # The two leading directions of three themes stand clear; of the others, the energy they hold counts.
    assert np.linalg.svd(loadings[:, :3].T @ right[:, :3])[1].min() > 0.999
    energy = lambda v: np.linalg.norm(dense @ v) ** 2
    assert energy(loadings) > 0.995 * energy(right)
    found = vectors.text_vectors(messages, spark.createDataFrame(model), "id", "message").collect()
    for row in found[:20]:
        own = dense[row["id"]] @ loadings
        assert np.allclose(row["embedding"], own / np.linalg.norm(own), atol=1e-9)


def test_topics_from_text_alone(spark, messages):
    model = vectors.fit_vectors(vectors.bucket_counts(messages, "id", "message", 1024).persist(), 8, 1024).persist()
    labels = spark.createDataFrame(list(THEMES.items()), "topic string, words string")
    tagged = topics.text_topics(messages, labels, model, "id")
    wrong = tagged.where(F.col("class") != F.col("theme")).count()
    assert tagged.count() == messages.count() and wrong <= 2
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "99"), (4, "zzqx"), (5, "goal"), (6, "bank " * 30_000)], "id long, message string")
    found = {r["id"]: r["class"] for r in topics.text_topics(odd, labels, model, "id").collect()}
    assert found[6] == "money" and {found[i] for i in (1, 2, 3, 5)} == {"etc"} and len(found) == 6


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, message string")
    model = vectors.fit_vectors(vectors.bucket_counts(none, "id", "message", 16), 4, 16)
    assert {tuple(r["loadings"]) for r in model.collect()} == {(0.0,) * 4}
    assert vectors.text_vectors(none, model, "id", "message").count() == 0
    some = spark.createDataFrame([(1, "a few words", 5)], "id long, message string, embedding int")
    row = vectors.text_vectors(some, model, "id", "message").first()
    assert row["embedding"] is None and row["message"] == "a few words"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_need_no_shuffle_of_grams(spark):
    rows = spark.createDataFrame([(i, "one two two one two " * (i % 9)) for i in range(50)], "id long, message string")
    assert "Exchange" not in plan_of(vectors.ngram_counts(rows, "id", "message"))
    assert "Exchange" not in plan_of(vectors.bucket_counts(rows, "id", "message", 64))


def test_rows_with_one_key_are_one_message(spark):
    rows = [(1, "the cat the"), (1, "the cat"), (2, "Zoë the cat"), (None, "a b"), (None, "b a b"), (3, None), (3, ""), (4, None), (5, "x")]
    asked = spark.createDataFrame(rows, "id long, message string")
    expected = {}
    for key, message in rows:
        expected.setdefault(key, Counter()).update(grams_of(message))
    found = vectors.ngram_counts(asked, "id", "message").collect()
    assert len(found) == len({(r["id"], r["gram"]) for r in found})
    assert {(r["id"], r["gram"]): r["count"] for r in found} == {(k, g): n for k, c in expected.items() for g, n in c.items()}
    hashed = spark.createDataFrame(found).withColumn("bucket", F.expr("cast(pmod(xxhash64(gram), 8) as int)"))
    buckets = {(r["id"], r["bucket"]): r["n"] for r in hashed.groupBy("id", "bucket").agg(F.sum("count").alias("n")).collect()}
    counted = vectors.bucket_counts(asked, "id", "message", 8)
    assert counted.dtypes == [("id", "bigint"), ("entries", "array<struct<bucket:int,count:bigint>>")]
    lists = {r["id"]: [tuple(e) for e in r["entries"]] for r in counted.collect()}
    assert {(k, b): n for k, e in lists.items() for b, n in e} == buckets and all(e == sorted(e) for e in lists.values())


def test_the_check_of_vectors_sends_the_model_to_the_entries(spark):
    from hubbub.plans import catalog

    least = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(least)
    spark.conf.set(least, "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(catalog.queries()["text_vectors"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set(least, before)
