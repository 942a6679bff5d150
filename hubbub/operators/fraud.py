"""Screening of credentials by reading behaviour."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubbub.functions.constants import (
    BOT_CLASS,
    CLASS_NAMES,
    CREDENTIAL_FEATURES,
    HUMAN_CLASS,
    ONE_CLASS_MODEL,
)
from hubbub.functions.times import elapsed_ms, moment, utc
from hubbub.operators.ordering import first_per_key, hash_order, previous_time
from hubbub.operators.upsert import consume, update_only

_USER = "seen_credential"
_ROW_KEYS = [_USER, "first_seen_at", "last_seen_at"]


def reading_times(feeditems: DataFrame) -> DataFrame:
    """Seconds on screen, and seconds since the user's previous seen item, per feed item.

    The previous item is taken before invalid rows (left the screen before being seen) are
    dropped; a user's first item has none and is dropped too.
    """
    complete = feeditems.where(
        F.col(_USER).isNotNull() & F.col("seen_at").isNotNull() & F.col("off_screen_at").isNotNull()
    ).select(_USER, "id", "seen_at", "off_screen_at")
    lagged = previous_time(complete, _USER, "seen_at", "id", "_previous")
    timed = lagged.select(
        _USER,
        "id",
        "seen_at",
        "off_screen_at",
        (elapsed_ms(F.col("off_screen_at"), F.col("seen_at")) / 1000).alias("reading_sec"),
        (elapsed_ms(F.col("seen_at"), F.col("_previous")) / 1000).alias("difference_sec"),
    )
    return timed.where((F.col("reading_sec") >= 0) & F.col("difference_sec").isNotNull())


def last_n(rows: DataFrame, n: int = 500, minimum: int = 500) -> DataFrame:
    """The latest ``n`` rows of each user; users with fewer than ``minimum`` are dropped."""
    newest = Window.partitionBy(_USER).orderBy(F.col("seen_at").desc(), F.col("id").desc())
    latest = rows.withColumn("_row", F.row_number().over(newest)).where(F.col("_row") <= n)
    kept = F.count(F.lit(1)).over(Window.partitionBy(_USER))
    return latest.withColumn("_kept", kept).where(F.col("_kept") >= minimum).drop("_row", "_kept")


def _abs_skew(x: Column) -> Column:
    n = F.count(x)
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.abs(factor * F.skewness(x))


def _abs_excess_kurtosis(x: Column) -> Column:
    n = F.count(x)
    factor = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.abs(factor * ((n + 1) * F.kurtosis(x) + 6))


def _relative_deviation(x: Column) -> Column:
    return F.try_divide(F.stddev_samp(x), F.avg(x))


def credential_features(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Shape of each user's reading times and gaps, outliers above the 95 % quantile left out.

    Expects the bounded rows of ``last_n``; its partitioning by user serves every step here.
    Users with an undefined feature are dropped.
    """
    user = Window.partitionBy(_USER)
    cut = rows.withColumns(
        {
            "_reading_cut": F.percentile("reading_sec", F.lit(0.95)).over(user),
            "_difference_cut": F.percentile("difference_sec", F.lit(0.95)).over(user),
        }
    )
    reading = F.when(F.col("reading_sec") <= F.col("_reading_cut"), F.col("reading_sec"))
    difference = F.when(
        F.col("difference_sec") <= F.col("_difference_cut"), F.col("difference_sec")
    )
    features = cut.groupBy(_USER).agg(
        F.min("seen_at").alias("first_seen_at"),
        F.max("seen_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("count"),
        _abs_skew(reading).alias("post_reading_time_abs_skew"),
        _abs_excess_kurtosis(reading).alias("post_reading_time_abs_kurt"),
        _relative_deviation(reading).alias("post_reading_time_norm_std"),
        _relative_deviation(difference).alias("post_reading_time_difference_norm_std"),
    )
    now = moment(rows, "seen_at", as_of)
    return features.na.drop(subset=list(CREDENTIAL_FEATURES)).withColumns(
        {"created_at": now, "updated_at": now}
    )


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def one_class_dataset(features: DataFrame, n: int = 10_000) -> DataFrame:
    """The ``n`` most recently verified complete rows."""
    verified = _complete(features, [*CREDENTIAL_FEATURES, "verification_status", "verified_at"])
    return verified.orderBy(F.col("verified_at").desc(), *_ROW_KEYS).limit(n)


def train_gate(dataset: DataFrame, folds: int = 5, bot_status: bool = False) -> DataFrame:
    """Bot rows found, and whether they suffice for ``folds`` folds."""
    bots = F.count_if(F.col("verification_status") == F.lit(bot_status))
    return dataset.agg(bots.alias("bot_rows")).withColumn(
        "trainable", F.col("bot_rows") >= F.lit(folds)
    )


def with_label(dataset: DataFrame, bot_status: bool = False) -> DataFrame:
    """Adds ``label``: 0 for bots, 1 for humans."""
    is_bot = F.col("verification_status") == F.lit(bot_status)
    return dataset.withColumn("label", F.when(is_bot, BOT_CLASS).otherwise(HUMAN_CLASS))


def stratified_splits(
    labelled: DataFrame, id_column: str, folds: int = 5, train_share: float = 0.8, seed: int = 0
) -> DataFrame:
    """Each row once per fold with ``is_train``; the share holds within each label.

    Rows are ordered by a hash of (seed, fold, id), so a fold is the same on every run.
    """
    repeated = labelled.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    hashed = F.md5(
        F.concat_ws(":", F.lit(str(seed)), "fold", F.col(id_column).cast("string")).cast("binary")
    )
    numbered = hash_order(repeated, hashed, ["fold", "label"], id_column, "_place", "_size")
    return numbered.withColumn(
        "is_train", F.col("_place") < F.floor(F.col("_size") * F.lit(train_share))
    ).drop("_place", "_size")


def _distance(features: Sequence[str], mean: Column, component: Column) -> Column:
    """Distance of a row from its projection on the component."""
    centred = [F.col(name) - F.get(mean, F.lit(i)) for i, name in enumerate(features)]
    along = [F.get(component, F.lit(i)) for i in range(len(features))]
    projection = sum(c * a for c, a in zip(centred, along))
    return F.sqrt(sum((c - projection * a) * (c - projection * a) for c, a in zip(centred, along)))


def _with_model(rows: DataFrame, models: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Adds the parts of a row's model as ``_model``.

    Rows without a ``fold`` share one model, a scalar subquery that fails on several. Rows of
    folds are joined on it.
    """
    model = models.select("fold", F.struct(*parts).alias("_model"))
    if "fold" not in rows.columns:
        return rows.withColumn("_model", model.select("_model").scalar())
    return rows.join(model, "fold")


def fit_one_class_pca(
    rows: DataFrame, as_of: datetime, features: Sequence[str] = CREDENTIAL_FEATURES
) -> DataFrame:
    """One-component PCA per ``fold`` (one fold, 0, when there is no such column).

    The distance of a row from its reconstruction is bounded by the training distances, widened
    by a tenth of their range. All folds are fitted by the same two aggregations: covariances,
    then distance bounds. Only a features-by-features matrix per fold reaches Python.
    """
    names = list(features)
    fold = F.col("fold") if "fold" in rows.columns else F.lit(0).alias("fold")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    spread = rows.groupBy(fold).agg(
        F.array(*[F.avg(name) for name in names]).alias("mean"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).alias("covariance"),
    )

    def principal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            components = []
            for upper in batch["covariance"]:
                matrix = np.zeros((len(names), len(names)))
                for (i, j), value in zip(pairs, upper):
                    matrix[i, j] = matrix[j, i] = value
                components.append(np.linalg.eigh(matrix)[1][:, -1])
            yield pd.DataFrame(
                {"fold": batch["fold"], "mean": batch["mean"], "component": components}
            )

    axes = spread.mapInPandas(
        principal, "fold int, mean array<double>, component array<double>"
    )
    model = F.col("_model")
    bounds = (
        _with_model(rows, axes, ["mean", "component"])
        .withColumn("_distance", _distance(names, model["mean"], model["component"]))
        .groupBy(fold)
        .agg(
            F.first(model["mean"]).alias("mean"),
            F.first(model["component"]).alias("component"),
            F.count(F.lit(1)).alias("rows"),
            F.min("_distance").alias("low"),
            F.max("_distance").alias("high"),
        )
    )
    margin = (F.col("high") - F.col("low")) * 0.1
    return bounds.select(
        "fold",
        F.lit(ONE_CLASS_MODEL).alias("model"),
        F.array(*[F.lit(name) for name in names]).alias("features"),
        "mean",
        "component",
        (F.col("low") - margin).alias("lower_bound"),
        (F.col("high") + margin).alias("upper_bound"),
        "rows",
        F.lit(utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f"))
        .cast("timestamp_ntz")
        .alias("trained_at"),
    )


def predict_one_class(
    rows: DataFrame, models: DataFrame, features: Sequence[str] = CREDENTIAL_FEATURES
) -> DataFrame:
    """Adds ``distance`` and ``predicted``: 1 (human) outside the bounds, 0 (bot) inside.

    Both are null where there is no model.
    """
    model = F.col("_model")
    scored = _with_model(rows, models, ["mean", "component", "lower_bound", "upper_bound"])
    outside = (F.col("distance") > model["upper_bound"]) | (
        F.col("distance") < model["lower_bound"]
    )
    return (
        scored.withColumn("distance", _distance(features, model["mean"], model["component"]))
        .withColumn("predicted", F.when(outside, HUMAN_CLASS).when(~outside, BOT_CLASS))
        .select(*rows.columns, "distance", "predicted")
    )


def classification_report(predictions: DataFrame) -> DataFrame:
    """Mean over folds of accuracy and per-class, macro and weighted scores, one metric per row.

    Needs ``fold``, ``label`` and ``predicted``. A ratio without cases is 0.
    """
    label, predicted = F.col("label"), F.col("predicted")
    counted = predictions.groupBy("fold").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(label == predicted).alias("_right"),
        *[
            column
            for code, name in CLASS_NAMES.items()
            for column in (
                F.count_if((label == code) & (predicted == code)).alias(f"_{name}_hit"),
                F.count_if(label == code).alias(f"_{name}_support"),
                F.count_if(predicted == code).alias(f"_{name}_called"),
            )
        ],
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    scores: dict[str, Column] = {"accuracy": ratio(F.col("_right"), F.col("_n"))}
    names = list(CLASS_NAMES.values())
    for name in names:
        hit, support, called = (F.col(f"_{name}_{c}") for c in ("hit", "support", "called"))
        scores[f"{name}_precision"] = ratio(hit, called)
        scores[f"{name}_recall"] = ratio(hit, support)
        scores[f"{name}_f1-score"] = ratio(2 * hit, called + support)
        scores[f"{name}_support"] = support.cast("double")
    for measure in ("precision", "recall", "f1-score"):
        per_class = [scores[f"{name}_{measure}"] for name in names]
        supports = [F.col(f"_{name}_support") for name in names]
        scores[f"macro_avg_{measure}"] = sum(per_class) / len(names)
        scores[f"weighted_avg_{measure}"] = ratio(
            sum(p * s for p, s in zip(per_class, supports)), sum(supports)
        )
    for average in ("macro_avg", "weighted_avg"):
        scores[f"{average}_support"] = sum(F.col(f"_{name}_support") for name in names).cast(
            "double"
        )
    means = counted.agg(*[F.avg(column).alias(metric) for metric, column in scores.items()])
    return means.unpivot([], list(scores), "metric", "value")


def latest_unverified(
    features: DataFrame, feature_names: Sequence[str] = CREDENTIAL_FEATURES
) -> DataFrame:
    """The newest complete row of each user, where that row is not verified yet."""
    complete = _complete(features, [*_ROW_KEYS, *feature_names])
    order = [F.col("created_at").desc(), F.col("last_seen_at").desc(), F.col("first_seen_at").desc()]
    newest = first_per_key(complete, [_USER], order)
    return newest.where(F.col("verification_status").isNull() & F.col("verified_at").isNull())


def last_verified(
    features: DataFrame, feature_names: Sequence[str] = CREDENTIAL_FEATURES
) -> DataFrame:
    """The time of each user's latest verification."""
    verified = _complete(
        features, [*_ROW_KEYS, *feature_names, "verification_status", "verified_at"]
    )
    return verified.groupBy(_USER).agg(F.max("verified_at").alias("verified_at"))


def suspicious_users(
    predictions: DataFrame, verified: DataFrame, as_of: datetime, cooldown_hours: int = 1
) -> DataFrame:
    """Users predicted as bots that were never verified, or not within the cooldown."""
    bots = predictions.where(F.col("predicted") == BOT_CLASS).select(*_ROW_KEYS)
    now = moment(verified, "verified_at", as_of)
    rested = now - F.col("verified_at") >= F.expr(f"INTERVAL '{int(cooldown_hours)}' HOUR")
    return (
        bots.join(verified.select(_USER, "verified_at"), _USER, "left")
        .where(F.col("verified_at").isNull() | rested)
        .select(*_ROW_KEYS, now.alias("created_at"))
    )


def apply_verification(
    features: DataFrame, suspicious: DataFrame, as_of: datetime, as_coded: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Feature rows with their verification set, and the suspicious rows left to process.

    A verified row is consumed when it matched a feature row; ``as_coded`` consumes it anyway.
    """
    fields = ["verification_status", "verified_at"]
    verified = _complete(suspicious, [*_ROW_KEYS, *fields])
    now = moment(features, "updated_at", as_of)
    source = verified.select(*_ROW_KEYS, *fields, now.alias("updated_at"))
    updated = update_only(features, source, _ROW_KEYS, [*fields, "updated_at"])
    done = verified if as_coded else verified.join(features.select(*_ROW_KEYS), _ROW_KEYS, "left_semi")
    return updated, consume(suspicious, done, ["id"])
