"""Best products against all pairs; checks of recommendations and clusters that a wrong row fails."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hubbub.operators import clusters, products, recommend, topics
from hubbub.plans.sample_views import AS_OF


def tables(spark, queries, items):
    return (
        spark.createDataFrame(queries, "query long, vector array<double>"),
        spark.createDataFrame(items, "item long, vector array<double>"),
    )


def brute(queries, items, k):
    out = []
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in items)
        out += [(q, i, -s) for s, i in scored[:k]]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 16, 4096])
def test_equals_all_pairs(spark, block):
    """Lengths over three orders of magnitude, ties, a zero vector and a query of zeros."""
    rng = random.Random(block)
    vector = lambda scale: [float(rng.randrange(-4, 5)) * scale for _ in range(4)]
    items = [(i, vector(rng.choice([1, 8, 64]))) for i in range(130)] + [(500, [0.0] * 4), (501, [64.0] * 4), (502, [64.0] * 4)]
    queries = [(i, vector(1)) for i in range(60)] + [(99, [0.0] * 4)]
    found = products.best_products(*tables(spark, queries, items), k=5, block=block)
    assert sorted((r["query"], r["item"], r["score"]) for r in found.collect()) == brute(queries, items, 5)


def test_few_items_and_no_items(spark):
    queries, items = [(1, [1.0, 2.0]), (2, [0.0, -1.0])], [(7, [3.0, 1.0]), (8, [1.0, 1.0])]
    found = products.best_products(*tables(spark, queries, items), k=5, block=1)
    assert sorted((r["query"], r["item"], r["score"]) for r in found.collect()) == brute(queries, items, 5)
    assert products.best_products(*tables(spark, queries, []), k=5).count() == 0
    assert products.best_products(*tables(spark, [], items), k=5).count() == 0


def pairs(spark, people=120, contents=90, seed=1):
    rng = random.Random(seed)
    rows = {(p, int(rng.paretovariate(1.1)) % contents): float(rng.randrange(1, 6)) for p in range(people) for _ in range(12)}
    return spark.createDataFrame([(p, c, s) for (p, c), s in rows.items()], "person_id long, content_id long, event_strength double")


def test_recommendations_against_the_whole_grid(spark):
    """Every twentieth person against all contents: no content that is left out scores higher."""
    persons, contents, people, items = recommend.fit_factors(pairs(spark).persist())
    scores = recommend.best_contents(persons, contents, 10, block=8)
    plan = scores._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    wanted = {r["user"] for r in people.where("person_id % 20 = 0").collect()}
    own = {r["id"]: r["features"] for r in persons.collect() if r["id"] in wanted}
    other = [(r["id"], r["features"]) for r in contents.collect()]
    found = {}
    for r in scores.collect():
        found.setdefault(r["user"], set()).add(r["content"])
    assert len(own) == 6
    for user, vector in own.items():
        ranked = sorted((-sum(x * y for x, y in zip(vector, b)), i) for i, b in other)
        assert found[user] == {i for _, i in ranked[:10]}


def test_wanted_people_only(spark):
    rows = pairs(spark).persist()
    wanted = spark.createDataFrame([(3,), (4,), (10**6,)], "person_id long")
    some, people, _ = recommend.member_recommendations(rows, k=4, people_wanted=wanted)
    named = some.join(people, "user").groupBy("person_id").count().collect()
    assert sorted((r["person_id"], r["count"]) for r in named) == [(3, 4), (4, 4)]


def test_a_wrong_score_is_seen(spark):
    persons, contents, _, _ = recommend.fit_factors(pairs(spark).persist())
    scores = recommend.best_contents(persons, contents, 5)
    right = recommend.checked_scores(scores, persons, contents)
    assert right.where("NOT is_product").isEmpty() and right.agg(F.max("rank")).first()[0] == 5
    wrong = scores.withColumn("score", F.when(F.col("user") == 1, F.col("score") + 1e-4).otherwise(F.col("score")))
    assert recommend.checked_scores(wrong, persons, contents).where("NOT is_product").select("user").distinct().count() == 1


def test_a_wrong_class_is_seen(spark):
    rng = random.Random(2)
    rows = [(i, Vectors.sparse(6, sorted((c, float(rng.randrange(1, 9))) for c in rng.sample(range(6), 3)))) for i in range(80)]
    vectors = spark.createDataFrame(rows, ["user_id", "features"]).persist()
    fitted = clusters.fit_clusters(vectors, k=4)
    labels = clusters.labelled_users(fitted, vectors, AS_OF)
    right = clusters.with_distances(labels, vectors, fitted)
    assert right.count() == 80 and right.where("own_distance > least_distance + 1e-9").isEmpty()
    wrong = labels.withColumn("user_class", (F.col("user_class") + 1) % 4)
    assert clusters.with_distances(wrong, vectors, fitted).where("own_distance > least_distance + 1e-9").count() > 70
    centers = fitted.clusterCenters()
    for r in labels.collect():
        own = dict(rows)[r["user_id"]].toArray()
        assert min(range(4), key=lambda c: ((own - centers[c]) ** 2).sum()) == r["user_class"]


def test_ten_thousand_labels(spark):
    """Blocks of labels: exact, ties to the first topic, and a plan that does not grow with the labels."""
    rng = random.Random(8)
    vector = lambda: [round(rng.gauss(0, 1), 3) for _ in range(5)]
    labels = [(f"t{i:05}", vector()) for i in range(10_000)]
    labels += [("twin-b", [9.0, 9.0, 9.0, 9.0, 9.0]), ("twin-a", [9.0, 9.0, 9.0, 9.0, 9.0]), (None, [99.0] * 5), ("none", None)]
    rows = [(i, vector(), "two words") for i in range(40)] + [(100, [1.0] * 5, "two words"), (101, None, "two words"), (102, [1.0] * 5, "word")]
    vectors = spark.createDataFrame(rows, "content_id int, embedding array<double>, message string")
    frame = spark.createDataFrame(labels, "topic string, embedding array<double>")
    found = topics.embedding_topics(vectors, frame)
    classes = {r["content_id"]: r["class"] for r in found.collect()}
    usable = [(t, e) for t, e in labels if t is not None and e is not None]
    for i, v, message in rows:
        if v is None or message == "word":
            assert classes[i] == "etc"
        else:
            assert classes[i] == min((-sum(x * y for x, y in zip(v, e)), t) for t, e in usable)[1]
    assert classes[100] == "twin-a"
    fewer = topics.embedding_topics(vectors, frame.where("topic < 't05000' OR topic LIKE 'twin%'"))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(found) == size(fewer)


def test_a_task_holds_a_bounded_number_of_scores(spark, monkeypatch):
    most, make = products.SCORES_AT_ONCE, products._scorer

    def watched():
        matrix, best = make()

        def counted(queries, items, *rest):
            if len(queries) * len(items) > most:
                raise ValueError(f"{len(queries)} x {len(items)} scores at once")
            return best(queries, items, *rest)

        return matrix, counted

    monkeypatch.setattr(products, "_scorer", watched)
    # Whole numbers, and many equal vectors: ties beyond the first block.
    vectors = np.random.default_rng(5).integers(-3, 4, (40, 3)).astype(float)
    queries = spark.createDataFrame([(i, vectors[i % 7].tolist()) for i in range(1500)], "query long, vector array<double>")
    items = spark.createDataFrame([(i, vectors[i % 40].tolist()) for i in range(1200)], "item long, vector array<double>")
    found = products.best_products(queries.coalesce(1), items, 5, block=1024).collect()
    asked, offered = vectors[np.arange(1500) % 7], vectors[np.arange(1200) % 40]
    places = np.argsort(-(asked @ offered.T), axis=1, kind="stable")[:, :5]
    assert {(r["query"], r["item"]) for r in found} == {(i, int(j)) for i in range(1500) for j in places[i]}
