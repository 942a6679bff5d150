"""Grouping users by the topics they engage with."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hubbub.functions.constants import TOPIC_MAP_TYPES
from hubbub.functions.times import utc
from hubbub.operators.ordering import dense_ids


def topic_places(counts: DataFrame, topics: DataFrame) -> DataFrame:
    """A number for each topic of the taxonomy and any other that was counted."""
    names = [df.select(F.col("topic_id").cast("string")) for df in (topics, counts)]
    return dense_ids(names[0].union(names[1]), "topic_id", "place")


def user_topic_vectors(counts: DataFrame, places: DataFrame) -> DataFrame:
    """One sparse vector per user: a count for each (engagement type, topic).

    The cell of a type and topic is ``type number * number of topics + place``. A user has at most
    as many entries as there are cells.
    """
    size = places.agg(F.count(F.lit(1))).scalar()
    kinds = F.array(*[F.lit(kind) for kind in TOPIC_MAP_TYPES])
    cell = (F.array_position(kinds, F.col("type")) - 1) * F.col("_topics") + F.col("place")
    entries = (
        counts.where(F.col("type").isin(*TOPIC_MAP_TYPES))
        .withColumn("topic_id", F.col("topic_id").cast("string"))
        .join(places, "topic_id")
        .withColumn("_topics", size)
        .groupBy("user_id", cell.cast("int").alias("cell"))
        .agg(F.sum("count").cast("double").alias("count"))
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(F.struct("cell", "count"))).alias("entries"))
    )
    sparse = entries.select(
        "user_id",
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            (size * len(TOPIC_MAP_TYPES)).cast("int").alias("size"),
            F.col("entries.cell").alias("indices"),
            F.col("entries.count").alias("values"),
        ).alias("features"),
    )
    vectors = StructType([sparse.schema["user_id"], StructField("features", VectorUDT())])
    return sparse.mapInArrow(lambda batches: batches, vectors)


def user_topic_matrix(vectors: DataFrame, places: DataFrame) -> DataFrame:
    """The matrix of ``user_topic_vectors`` as (user_id, cell, count) rows, zeros included."""
    size = places.agg(F.count(F.lit(1))).scalar()
    kinds = F.array(*[F.lit(kind) for kind in TOPIC_MAP_TYPES])
    rows = vectors.select(
        "user_id", F.posexplode(vector_to_array("features")).alias("number", "count")
    ).withColumn("_topics", size)
    kind = F.get(kinds, F.floor(F.col("number") / F.col("_topics")).cast("int"))
    return (
        rows.withColumn("place", (F.col("number") % F.col("_topics")).cast("long"))
        .join(places, "place")
        .select(
            "user_id",
            F.concat_ws(".", kind, F.col("topic_id")).alias("cell"),
            F.col("count").cast("long").alias("count"),
        )
    )


def fit_clusters(vectors: DataFrame, k: int = 7, seed: int = 1) -> KMeansModel:
    """K-means over the sparse ``features`` of each user. ``vectors`` is read several times."""
    return KMeans(k=k, seed=seed).fit(vectors)


def labelled_users(fitted: KMeansModel, vectors: DataFrame, as_of: datetime, model: str = "kmeans") -> DataFrame:
    """The label of each user by a fitted model."""
    return fitted.transform(vectors).select(
        "user_id",
        F.col("prediction").alias("user_class"),
        F.lit(model).alias("model"),
        F.lit(utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f"))
        .cast("timestamp_ntz")
        .alias("predicted_at"),
    )


def user_clusters(
    vectors: DataFrame, as_of: datetime, k: int = 7, seed: int = 1, model: str = "kmeans"
) -> DataFrame:
    """A cluster label per user, from the sparse ``features`` of each."""
    return labelled_users(fit_clusters(vectors, k, seed), vectors, as_of, model)


def with_distances(labels: DataFrame, vectors: DataFrame, fitted: KMeansModel) -> DataFrame:
    """``labels`` with the squared distance to the own centroid and to the nearest one."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(fitted.clusterCenters())]
    centers = vectors.sparkSession.createDataFrame(rows, "number int, center array<double>")
    every = centers.agg(F.array_sort(F.collect_list(F.struct("number", "center")))).scalar()
    own = vectors.select("user_id", vector_to_array("features").alias("_x"), every.alias("_centers"))

    def distance(center):
        parts = F.zip_with("_x", center["center"], lambda x, y: (x - y) * (x - y))
        return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)

    far = own.select("user_id", F.transform("_centers", distance).alias("_far"))
    return (
        labels.join(far, "user_id")
        .withColumn("own_distance", F.get("_far", F.col("user_class")))
        .withColumn("least_distance", F.array_min("_far"))
        .drop("_far")
    )
