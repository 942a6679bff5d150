"""One regression per key, from sufficient statistics.

The rows of a key are never gathered: a grouped aggregate (combined map-side) reduces them to one
row of sums, and only that row is solved. Models are plain columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from hubbub.functions.times import utc


def moments(rows: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    """Means and covariances per key, from which no large sums have to be subtracted."""
    x = [F.col(name).cast("double") for name in features]
    y = F.col(label).cast("double")
    upper = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.avg(a) for a in x]).alias("mean_x"),
        F.avg(y).alias("mean_y"),
        F.array(*[F.covar_pop(x[i], x[j]) for i, j in upper]).alias("covariance"),
        F.array(*[F.covar_pop(a, y) for a in x]).alias("cross"),
    )


def _solver(key: str, width: int, penalty: float):
    """A batch function solving every row's standardised ridge regression at once.

    Everything it calls is nested in it, so it travels to the workers whole and they need no copy
    of this package.
    """

    def ridge(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        mean_x = np.stack(batch["mean_x"].to_numpy())
        mean_y = batch["mean_y"].to_numpy(dtype=float)
        covariance = np.zeros((len(batch), width, width))
        rows, cols = np.triu_indices(width)
        covariance[:, rows, cols] = np.stack(batch["covariance"].to_numpy())
        covariance[:, cols, rows] = covariance[:, rows, cols]
        cross = np.stack(batch["cross"].to_numpy())

        variance = np.clip(np.diagonal(covariance, axis1=1, axis2=2), 0.0, None)
        varies = variance > 1e-24 * (1.0 + mean_x**2)
        scale = np.where(varies, np.sqrt(np.where(varies, variance, 1.0)), 1.0)
        both = varies[:, :, None] & varies[:, None, :]
        correlation = np.where(both, covariance / (scale[:, :, None] * scale[:, None, :]), 0.0)
        system = correlation + penalty * np.eye(width)
        target = np.where(varies, cross / scale, 0.0)
        coefficients = np.linalg.solve(system, target[:, :, None])[:, :, 0] / scale
        return mean_y - (coefficients * mean_x).sum(axis=1), coefficients

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            intercepts, coefficients = ridge(batch)
            yield pd.DataFrame(
                {
                    "account": batch[key],
                    "intercept": intercepts,
                    "coefficients": list(coefficients),
                    "rows": batch["rows"],
                }
            )

    return solve


def fit_per_key(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    as_of: datetime,
    model: str = "ridge",
    penalty: float = 0.1,
) -> DataFrame:
    """One ridge regression per key on standardised features.

    Returns one row per key: ``account`` (the key), ``model``, ``features``, ``intercept``,
    ``coefficients``, ``rows`` and ``trained_at``.
    """
    names = list(features)
    sums = moments(rows, key, names, label)
    key_type = sums.schema[key].dataType
    solved = StructType(
        [
            StructField("account", key_type),
            StructField("intercept", DoubleType()),
            StructField("coefficients", ArrayType(DoubleType())),
            StructField("rows", LongType()),
        ]
    )

    trained = F.lit(utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return sums.mapInPandas(_solver(key, len(names), penalty), solved).select(
        "account",
        F.lit(model).alias("model"),
        F.array(*[F.lit(name) for name in names]).cast(ArrayType(StringType())).alias("features"),
        "intercept",
        "coefficients",
        "rows",
        trained.alias("trained_at"),
    )


def normal_residuals(
    models: DataFrame,
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    penalty: float = 0.1,
) -> DataFrame:
    """``models`` with ``residual``: how far each is from solving its rows' normal equations.

    The largest over the features, relative to the spread of the feature and of the label.
    """
    own = models.select(F.col("account").alias("_account"), F.col("coefficients").alias("_b"))
    joined = rows.join(own, F.col(key) == F.col("_account"))
    x = {name: F.col(name).cast("double") for name in features}
    y = F.col(label).cast("double")
    fitted = sum((F.get("_b", F.lit(i)) * x[name] for i, name in enumerate(x)), F.lit(0.0))
    sums = joined.withColumn("_fitted", fitted).groupBy("_account").agg(
        *[F.covar_pop(x[n], F.col("_fitted")).alias(f"_f{i}") for i, n in enumerate(x)],
        *[F.covar_pop(x[n], y).alias(f"_c{i}") for i, n in enumerate(x)],
        *[F.var_pop(x[n]).alias(f"_v{i}") for i, n in enumerate(x)],
        F.var_pop(y).alias("_vy"),
    )
    rest = [
        F.abs(F.col(f"_f{i}") + penalty * F.col(f"_v{i}") * F.get("coefficients", F.lit(i)) - F.col(f"_c{i}"))
        / (F.sqrt(F.col(f"_v{i}") * F.col("_vy")) + F.lit(1e-9))
        for i in range(len(x))
    ]
    largest = F.greatest(*rest, F.lit(0.0))
    return models.join(sums, F.col("account") == F.col("_account")).select(
        *models.columns, F.when(F.col("_vy") > 0, largest).otherwise(0.0).alias("residual")
    )


def base_model_fallback(
    models: DataFrame, all_keys: DataFrame, base: str = "th", stored: DataFrame | None = None
) -> DataFrame:
    """Every key without a model gets a copy of the base key's model.

    ``all_keys`` has one column ``account``. The base model is looked for in ``stored`` when given,
    else in ``models``; nothing is added when there is none. ``models`` is read more than once, so
    pass saved rows rather than a fit to be repeated.
    """
    untrained = all_keys.select("account").distinct().join(
        models.select("account"), "account", "left_anti"
    )
    donor = F.struct(*[c for c in models.columns if c != "account"])
    donors = models if stored is None else stored
    base_row = donors.where(F.col("account") == base).agg(F.first(donor).alias("model"))
    copied = untrained.select("account", base_row.scalar().alias("donor"))
    return models.unionByName(copied.where(F.col("donor").isNotNull()).select("account", "donor.*"))


def latest_artifact(artifacts: DataFrame, model: str) -> DataFrame:
    """The most recently trained artifact of a model, as at most one row.

    Artifacts trained at the same moment are told apart by a hash of their content.
    """
    tie_break = F.xxhash64(F.to_json(F.struct(*artifacts.columns)))
    order = [F.col("trained_at").desc(), tie_break]
    return artifacts.where(F.col("model") == model).orderBy(*order).limit(1)
