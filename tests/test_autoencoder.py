"""The autoencoder against numpy, numerical slopes and the linear model of the same rank."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from hubbub.operators import autoencoder as ae

WIDTH = 30


def cells_of(spark, matrix):
    rows = [(i, [(int(c), float(r[c])) for c in np.flatnonzero(r)]) for i, r in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, entries array<struct<cell:int,value:double>>").repartition(3).persist()


def output(layers, x):
    bent = lambda v: np.where(v > 0, v, ae.LEAK * v)
    (a, b), (c, d), (e, f), (g, h) = layers
    return 1 / (1 + np.exp(-(bent((bent(x @ a.T + b) @ c.T + d) @ e.T + f) @ g.T + h)))


@pytest.fixture(scope="module")
def ring():
    """People like what lies near their place on a ring: one number, bent through many directions."""
    far = np.abs(np.random.default_rng(3).random(400)[:, None] - np.arange(WIDTH) / WIDTH)
    return np.where(np.minimum(far, 1 - far) < 0.12, 1.0, 0.0)


def test_slopes():
    random = np.random.default_rng(1)
    sizes = [6, 4, 2, 4, 6]
    flat = random.standard_normal(sum(n * (m + 1) for m, n in zip(sizes, sizes[1:])))
    x = random.random((5, 6))
    _, _, gradient = ae._network(6)
    found = ae._flat(gradient(ae._shaped(flat, sizes), x)[1])
    loss = lambda w: ((output(ae._shaped(w, sizes), x) - x) ** 2).sum()
    each = np.eye(len(flat)) * 1e-6
    assert np.allclose(found, [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in each], atol=1e-5)


def test_below_the_linear_model_on_held_out_people(spark, ring):
    train, held = ring[:320], ring[320:]
    model, losses = ae.fit_autoencoder(cells_of(spark, train), WIDTH, rank=2, hidden=32, epochs=50)
    assert len(losses) == 50 and losses[-1] < losses[0] / 5
    layers = ae.model_layers(model)
    own = ((output(layers, held) - held) ** 2).mean()
    # The linear model is fitted to the held-out people as well.
    cells = [(u, c, float(ring[u, c])) for u in range(len(ring)) for c in range(WIDTH)]
    als = ALS(userCol="u", itemCol="c", ratingCol="r", rank=2, regParam=0.001, maxIter=10, seed=1)
    rated = spark.createDataFrame(cells, "u int, c int, r float")
    linear = als.fit(rated).transform(rated.where("u >= 320")).agg(F.avg((F.col("r") - F.col("prediction")) ** 2)).first()[0]
    assert own < linear / 3


def test_scores_are_the_outputs(spark):
    random = np.random.default_rng(5)
    rows = sorted({(int(p), int(c)) for p, c in zip(random.integers(0, 40, 300), random.integers(100, 125, 300))})
    pairs = spark.createDataFrame([(p, c, float(random.integers(1, 9))) for p, c in rows], "person_id long, content_id long, event_strength double").persist()
    people, items = (ae.dense_ids(pairs, a, b).persist() for a, b in (("person_id", "user"), ("content_id", "content")))
    for width in (25, 7):
        cells = ae.person_cells(pairs, people, items, width).persist()
        model = ae.fit_autoencoder(cells, width, rank=3, hidden=8, epochs=4)[0]
        x = np.zeros((people.count(), width))
        for r in cells.collect():
            for e in r["entries"]:
                x[r["id"], e["cell"]] = e["value"]
        assert x.max() == 1 and x.min() == 0
        out = output(ae.model_layers(model), x)
        found, _, _ = ae.autoencoder_recommendations(pairs, width, k=5, rank=3, hidden=8, epochs=4)
        got = {}
        for r in found.collect():
            assert abs(r["score"] - out[r["user"], r["content"] % width]) < 1e-6
            got.setdefault(r["user"], []).append(r["score"])
        for user, scores in got.items():
            best = np.sort(out[user, np.arange(items.count()) % width])[::-1][:5]
            assert np.allclose(sorted(scores, reverse=True), best, atol=1e-6)
        assert len(got) == people.count()
    wanted = spark.createDataFrame([(rows[0][0],)], "person_id long")
    few, people, _ = ae.autoencoder_recommendations(pairs, 7, 5, wanted, rank=2, hidden=4, epochs=1)
    assert {r["person_id"] for r in few.join(people, "user").collect()} == {rows[0][0]}


def test_nobody(spark):
    none = spark.createDataFrame([], "person_id long, content_id long, event_strength double")
    found, people, items = ae.autoencoder_recommendations(none, 4, rank=2, hidden=3, epochs=2)
    assert found.count() == people.count() == items.count() == 0
