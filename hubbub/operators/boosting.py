"""Gradient-boosted regression trees for all keys at once, from histograms.

Features are cut at quantiles of their key's rows, so a row is a list of bin numbers. Growing one level of
one tree of every key is one aggregate over (key, node, feature, bin): sums of residuals and counts, combined
map-side, from which the best split of each node follows. No key's rows are gathered, and a hot key is many
partial histograms. Splits are rows; a row finds its node by its key's splits, at most ``2 ** depth - 1`` of
them. After each tree the rows' predictions are written (``saved``), so no plan grows with the trees.

The loss is squared error with penalty ``l2`` on a leaf's weight: with n rows of residual sum R in a node, the
weight is R / (n + l2), and a split gains R_l^2 / (n_l + l2) + R_r^2 / (n_r + l2) - R^2 / (n + l2). Equal gains, to
six digits after the point, go to the first feature, then to the lowest cut. A null feature value goes to the
left. Rows without a key or a label are left out. Every model starts at the mean label of its key, as tree 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubbub.functions.times import utc
from hubbub.session import saved

#: Gains of one split that differ in later digits count as equal, and smaller ones as none.
DIGITS = 6


def _first_node(level: int) -> int:
    return 2**level - 1


def _node_of(splits: Column, bins: Column, depth: int) -> Column:
    """The node a row ends in. ``splits`` maps a node to its feature and bin; children are 2n+1 and 2n+2."""
    node = F.lit(0)
    for _ in range(depth):
        node = _step(splits, bins, node)
    return node


def _step(splits: Column, bins: Column, node: Column) -> Column:
    split = F.try_element_at(splits, node)
    right = F.coalesce(F.get(bins, split["feature"]) > split["split"], F.lit(False)).cast("int")
    return F.when(split.isNull(), node).otherwise(2 * node + 1 + right)


def quantile_cuts(rows: DataFrame, key: str, features: Sequence[str], bins: int, accuracy: int = 10_000) -> DataFrame:
    """``_key`` and ``cuts``: for each feature the distinct quantiles of the key's rows."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = [
        F.coalesce(
            F.array_distinct(F.percentile_approx(F.col(name).cast("double"), shares, F.lit(accuracy))),
            F.array().cast("array<double>"),
        )
        for name in features
    ]
    return rows.groupBy(F.col(key).alias("_key")).agg(F.array(*cuts).alias("cuts"), F.avg("_label").alias("_base"))


def binned(rows: DataFrame, key: str, features: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``_key, label, bins, predicted``: a bin is the number of cuts below the value."""
    values = F.array(*[F.col(name).cast("double") for name in features])
    joined = rows.select(F.col(key).alias("_key"), F.col("_label").alias("label"), values.alias("_values")).join(cuts, "_key")
    number = F.zip_with("cuts", "_values", lambda c, v: F.size(F.filter(c, lambda x: x < v)))
    return joined.select("_key", "label", number.alias("bins"), F.col("_base").alias("predicted"))


def best_splits(rows: DataFrame, l2: float, min_rows: int) -> DataFrame:
    """The best split of each (key, node), if it gains anything: one histogram over all features."""
    histogram = (
        rows.select("_key", "node", "residual", F.posexplode("bins").alias("feature", "split"))
        .groupBy("_key", "node", "feature", "split")
        .agg(F.sum("residual").alias("r"), F.count(F.lit(1)).alias("n"))
    )
    whole = Window.partitionBy("_key", "node", "feature")
    left = whole.orderBy("split")
    summed = histogram.select(
        "_key",
        "node",
        "feature",
        "split",
        F.sum("r").over(left).alias("lr"),
        F.sum("n").over(left).alias("ln"),
        F.sum("r").over(whole).alias("r"),
        F.sum("n").over(whole).alias("n"),
    )
    share = lambda r, n: r * r / (n + F.lit(float(l2)))
    lr, ln, r, n = (F.col(c) for c in ("lr", "ln", "r", "n"))
    gain = F.round(share(lr, ln) + share(r - lr, n - ln) - share(r, n), DIGITS)
    found = summed.withColumn("gain", gain).where((ln >= min_rows) & (n - ln >= min_rows) & (F.col("gain") > 0))
    rank = F.struct("gain", -F.col("feature"), -F.col("split"))
    chosen = F.struct("feature", "split", "gain", "lr", "ln", "r", "n")
    return found.groupBy("_key", "node").agg(F.max_by(chosen, rank).alias("best")).select("_key", "node", "best.*")


def _as_map(splits: DataFrame) -> DataFrame:
    entry = F.struct(F.col("node"), F.struct("feature", "split").alias("at"))
    return splits.groupBy("_key").agg(F.map_from_entries(F.collect_list(entry)).alias("splits"))


def _placed(rows: DataFrame, splits: DataFrame, depth: int) -> DataFrame:
    """Rows with their node. A key without splits has none in ``splits``: its rows are at the root."""
    joined = rows.join(_as_map(splits), "_key", "left")
    return joined.withColumn("node", _node_of(F.col("splits"), F.col("bins"), depth)).drop("splits")


def fit_boosted(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    bins: int = 64,
    l2: float = 1.0,
    min_rows: int = 1,
) -> DataFrame:
    """Trees of every key as rows: ``key, tree, node, feature, threshold, value, rows, gain``.

    An inner node has ``feature`` (its place in ``features``) and ``threshold``: greater values go to
    node 2n+2, others to 2n+1. A leaf has ``value``, with the learning ``rate`` in it. Growing stops
    when no key has a split left.
    """
    known = rows.withColumn("_label", F.col(label).cast("double")).where(F.col(key).isNotNull() & F.col("_label").isNotNull())
    cuts = saved(quantile_cuts(known, key, features, bins))
    data = saved(binned(known, key, features, cuts))
    result = cuts.join(data.groupBy("_key").agg(F.count(F.lit(1)).alias("rows")), "_key").select(
        "_key",
        F.lit(0).alias("tree"),
        F.lit(0).alias("node"),
        F.lit(None).cast("int").alias("feature"),
        F.lit(None).cast("double").alias("threshold"),
        F.col("_base").alias("value"),
        "rows",
        F.lit(None).cast("double").alias("gain"),
    )
    for tree in range(1, trees + 1):
        splits = _grown(data, depth, l2, min_rows)
        if splits is None:
            break
        leaves = _leaves(splits, rate, l2)
        result = result.unionByName(_tree_rows(splits, leaves, cuts, tree))
        value = leaves.select(F.col("_key").alias("_of"), F.col("node").alias("_leaf"), "value")
        moved = _placed(data, splits, depth).join(
            value, (F.col("_key") == F.col("_of")) & (F.col("node") == F.col("_leaf")), "left"
        )
        predicted = F.col("predicted") + F.coalesce("value", F.lit(0.0))
        data = saved(moved.select("_key", "label", "bins", predicted.alias("predicted")))
    return result.withColumnRenamed("_key", key)


def _grown(data: DataFrame, depth: int, l2: float, min_rows: int) -> DataFrame | None:
    """The splits of one tree of every key, level by level; nothing where no node can be split."""
    splits = None
    for level in range(depth):
        placed = data.withColumn("node", F.lit(0)) if splits is None else _placed(data, splits, level)
        here = placed.where(F.col("node") >= _first_node(level)) if level else placed
        new = saved(best_splits(here.withColumn("residual", F.col("label") - F.col("predicted")), l2, min_rows))
        if new.isEmpty():
            break
        splits = new if splits is None else splits.unionByName(new)
    return splits


def _leaves(splits: DataFrame, rate: float, l2: float) -> DataFrame:
    """Children of splits that are not split themselves, with their weight."""
    side = lambda node, r, n: F.struct(node.alias("node"), r.alias("r"), n.alias("n"))
    node, lr, ln, r, n = (F.col(c) for c in ("node", "lr", "ln", "r", "n"))
    both = F.array(side(2 * node + 1, lr, ln), side(2 * node + 2, r - lr, n - ln))
    children = splits.select("_key", F.explode(both).alias("c")).select("_key", "c.*")
    ends = children.join(splits.select("_key", "node"), ["_key", "node"], "left_anti")
    return ends.select("_key", "node", (F.lit(float(rate)) * F.col("r") / (F.col("n") + l2)).alias("value"), F.col("n").alias("rows"))


def _tree_rows(splits: DataFrame, leaves: DataFrame, cuts: DataFrame, tree: int) -> DataFrame:
    threshold = F.get(F.get("cuts", F.col("feature")), F.col("split"))
    inner = splits.join(cuts.select("_key", "cuts"), "_key").select(
        "_key", "node", "feature", threshold.alias("threshold"), F.lit(None).cast("double").alias("value"), F.col("n").alias("rows"), "gain"
    )
    ends = leaves.select("_key", "node", "value", "rows")
    return inner.unionByName(ends, allowMissingColumns=True).withColumn("tree", F.lit(tree))


def predict_boosted(rows: DataFrame, models: DataFrame, key: str, features: Sequence[str], depth: int = 6, name: str = "predicted") -> DataFrame:
    """``rows`` with the prediction of their key's trees, null where the key has none.

    A key's trees travel as one array of node maps, walked in JVM expressions of the size of ``depth``.
    """
    at = F.struct("feature", "threshold", "value")
    nodes = models.groupBy(F.col(key).alias("_key"), "tree").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("node"), at.alias("at")))).alias("nodes")
    )
    forest = nodes.groupBy("_key").agg(F.collect_list("nodes").alias("forest"))
    values = F.array(*[F.col(f).cast("double") for f in features])

    def value_of(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            inner = F.try_element_at(tree, node)
            right = F.coalesce(F.get(F.col("_values"), inner["feature"]) > inner["threshold"], F.lit(False)).cast("int")
            return F.when(inner["feature"].isNull(), node).otherwise(2 * node + 1 + right)

        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
        return F.try_element_at(tree, leaf)["value"]

    joined = rows.withColumn("_values", values).join(forest, F.col(key) == F.col("_key"), "left")
    total = F.aggregate(F.transform("forest", value_of), F.lit(0.0), lambda a, b: a + b)
    return joined.withColumn(name, total).drop("_values", "_key", "forest")


def as_models(trees: DataFrame, key: str, features: Sequence[str], as_of: datetime, model: str = "boosted") -> DataFrame:
    """One row per key, like those of ``fit_per_key``: the trees as an array of structs."""
    trained = F.lit(utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    node = F.struct("tree", "node", "feature", "threshold", "value")
    return trees.groupBy(F.col(key).alias("account")).agg(
        F.lit(model).alias("model"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array_sort(F.collect_list(node)).alias("trees"),
        F.max(F.when(F.col("tree") == 0, F.col("rows"))).alias("rows"),
        trained.alias("trained_at"),
    )
