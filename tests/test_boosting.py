"""Boosted trees against a plain implementation, and against ridge on non-linear data."""

import random

import pytest
from pyspark.sql import functions as F

from hubbub.operators import boosting, models
from hubbub.plans.sample_views import AS_OF


def plain_quantiles(values, bins):
    """Distinct quantiles as the rank-based percentile gives them."""
    known = sorted(v for v in values if v is not None)
    out = []
    for i in range(1, bins):
        if known:
            at = max(0, -(-i * len(known) // bins) - 1)
            out.append(known[at])
    return sorted(set(out))


def plain_boost(rows, trees, depth, rate, bins, l2, min_rows):
    """rows of (features, label) of one key -> {(tree, node): (feature, threshold, value)}."""
    width = len(rows[0][0])
    cuts = [plain_quantiles([x[f] for x, _ in rows], bins) for f in range(width)]
    below = lambda f, v: 0 if v is None else sum(c < v for c in cuts[f])
    binned = [[below(f, x[f]) for f in range(width)] for x, _ in rows]
    labels = [y for _, y in rows]
    base = sum(labels) / len(labels)
    predicted = [base] * len(rows)
    out = {(0, 0): (None, None, base)}
    for tree in range(1, trees + 1):
        members, grown = {0: list(range(len(rows)))}, False
        for node in range(2 ** (depth + 1) - 1):
            own = members.get(node)
            if own is None:
                continue
            residual = [labels[i] - predicted[i] for i in own]
            total, best = sum(residual), None
            if node < 2**depth - 1:
                for f in range(width):
                    for split in range(len(cuts[f])):
                        left = [r for i, r in zip(own, residual) if binned[i][f] <= split]
                        n, m = len(left), len(own) - len(left)
                        if min(n, m) < min_rows:
                            continue
                        g = sum(left)
                        gain = round(g * g / (n + l2) + (total - g) ** 2 / (m + l2) - total**2 / (len(own) + l2), 6)
                        if gain > 0 and (best is None or gain > best[0]):
                            # the lowest bin that holds these rows
                            best = gain, f, split
            if best is None:
                if node or grown:
                    out[tree, node] = (None, None, rate * total / (len(own) + l2))
                continue
            grown, (_, f, split) = True, best
            out[tree, node] = (f, cuts[f][split], None)
            members[2 * node + 1] = [i for i in own if binned[i][f] <= split]
            members[2 * node + 2] = [i for i in own if binned[i][f] > split]
        if not grown:
            continue
        for (t, node), (f, _, value) in list(out.items()):
            if t == tree and f is None:
                for i in members[node]:
                    predicted[i] += value
    return out, predicted


def frame(spark, keyed):
    rows = [(k, *x, y) for k, own in keyed.items() for x, y in own]
    return spark.createDataFrame(rows, "k string, a double, b double, c double, y double")


def found_trees(trees):
    out = {}
    for r in trees.collect():
        value = None if r["value"] is None else round(r["value"], 9)
        out.setdefault(r["k"], {})[r["tree"], r["node"]] = (r["feature"], r["threshold"], value)
    return out


@pytest.mark.parametrize("setting", [dict(trees=3, depth=2, bins=8, min_rows=1), dict(trees=2, depth=3, bins=4, min_rows=3)])
def test_equals_plain_boosting(spark, setting):
    rng = random.Random(setting["depth"])
    value = lambda: rng.choice([None, *[float(x) for x in range(9)]])
    keyed = {
        key: [((value(), value(), float(rng.randrange(2))), float(rng.randrange(12))) for _ in range(n)]
        for key, n in (("one", 1), ("few", 5), ("some", 60), ("more", 150))
    }
    keyed["same"] = [((1.0, 2.0, 3.0), 4.0)] * 9
    trees = boosting.fit_boosted(frame(spark, keyed), "k", ["a", "b", "c"], "y", rate=0.5, l2=1.0, **setting)
    found = found_trees(trees)
    for key, own in keyed.items():
        expected, _ = plain_boost(own, rate=0.5, l2=1.0, **setting)
        assert found[key] == {n: (f, t, None if v is None else round(v, 9)) for n, (f, t, v) in expected.items()}, key


def test_predictions_are_those_of_training(spark):
    rng = random.Random(4)
    own = [((float(rng.randrange(9)), None if i % 7 == 0 else float(i % 5), 0.0), float(rng.randrange(9))) for i in range(80)]
    rows = frame(spark, {"k1": own})
    trees = boosting.fit_boosted(rows, "k", ["a", "b", "c"], "y", trees=4, depth=2, rate=0.3, bins=16)
    _, expected = plain_boost(own, 4, 2, 0.3, 16, 1.0, 1)
    scored = boosting.predict_boosted(rows, trees, "k", ["a", "b", "c"], depth=2)
    assert sorted(round(r["predicted"], 8) for r in scored.collect()) == sorted(round(p, 8) for p in expected)
    strange = spark.createDataFrame([("nobody", 1.0, 1.0, 1.0, 0.0)], rows.schema)
    assert boosting.predict_boosted(strange, trees, "k", ["a", "b", "c"], 2).first()["predicted"] is None


def test_error_below_ridge_on_nonlinear_data(spark):
    """A product of two features, which no line follows; held-out rows, two keys of unlike size."""
    rng = random.Random(5)
    rows = []
    for key, n in (("large", 1500), ("small", 300)):
        for i in range(n):
            a, b = rng.uniform(-1, 1), rng.uniform(-1, 1)
            rows.append((key, a, b, rng.random(), (a > 0) * 2.0 * (b > 0) + a * b + rng.gauss(0, 0.05), i % 5 == 0))
    data = spark.createDataFrame(rows, "k string, a double, b double, c double, y double, held boolean")
    train, held = data.where("NOT held"), data.where("held")
    names = ["a", "b", "c"]
    trees = boosting.fit_boosted(train, "k", names, "y", trees=8, depth=3, rate=0.5, bins=16)
    boosted = boosting.predict_boosted(held, trees, "k", names, depth=3)
    ridge = models.fit_per_key(train, "k", names, "y", AS_OF).select(F.col("account").alias("k"), "intercept", "coefficients")
    line = sum((F.get("coefficients", F.lit(i)) * F.col(n) for i, n in enumerate(names)), F.col("intercept"))
    errors = lambda df, p: {r["k"]: r["e"] for r in df.groupBy("k").agg(F.avg((p - F.col("y")) ** 2).alias("e")).collect()}
    of_trees, of_lines = errors(boosted, F.col("predicted")), errors(held.join(ridge, "k"), line)
    assert all(of_trees[k] < 0.3 * of_lines[k] for k in ("large", "small"))


def test_rows_without_label_or_key_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 2.0), ("b", None, None, None, 3.0)], "k string, a double, b double, c double, y double")
    trees = boosting.fit_boosted(rows, "k", ["a", "b", "c"], "y", trees=2, depth=2)
    assert [(r["k"], r["tree"], r["value"], r["rows"]) for r in trees.collect()] == [("b", 0, 3.0, 1)]
    assert boosting.fit_boosted(rows.limit(0), "k", ["a", "b", "c"], "y", trees=2).count() == 0
