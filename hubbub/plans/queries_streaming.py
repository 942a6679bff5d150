"""Registered query: the event-driven tagging job over a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hubbub.plans.queries_text import CONTENT_TOPICS_SQL
from hubbub.plans.registry import query
from hubbub.plans.sample_views import AS_OF, view_over
from hubbub.session import shared_dir
from hubbub.streaming import topics as stream
from hubbub.streaming.changelog import ChangeLog

_PARTS = 3


def _events(messages):
    """Messages as JSON change events."""
    document = F.struct(
        F.col("content_id").cast("string").alias("_id"),
        F.struct("message").alias("payload"),
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("updatedAt"),
        "category",
        F.col("translated_en").alias("translatedEN"),
        F.col("detected_language").alias("detectedLanguage"),
    )
    detail = F.struct(F.lit("insert").alias("operationType"), document.alias("fullDocument"))
    return messages.select(F.to_json(F.struct(detail.alias("detail"))).alias("value"))


@query(CONTENT_TOPICS_SQL)
def topic_stream(v):
    spark = v.spark
    folder = f"{shared_dir(spark)}/topic-stream-{uuid.uuid4()}"
    # Parts of mixed dates, one per batch: later batches hold older messages too. A part has as many
    # files as its size asks for, so a batch takes a third of them, not one file each.
    for part in range(_PARTS):
        v.documents.where(F.col("doc_id") % _PARTS == part).write.mode("append").parquet(f"{folder}/in")
    files = len(spark.read.schema(v.documents.schema).parquet(f"{folder}/in").inputFiles())
    documents = (
        spark.readStream.schema(v.documents.schema)
        .option("maxFilesPerTrigger", max(1, -(-files // _PARTS)))
        .parquet(f"{folder}/in")
    )
    messages = stream.event_messages(
        stream.parse_events(_events(view_over(spark, "messages", documents=documents)))
    )
    seed = v.topics.withColumns(
        {
            "parents": F.lit(None).cast("array<struct<_id:string,slug:string>>"),
            "children": F.lit(None).cast("array<struct<_id:string,slug:string>>"),
            "created_at": F.col("created_at").cast("timestamp"),
            "updated_at": F.col("updated_at").cast("timestamp"),
        }
    )
    columns = stream.TOPIC_SCHEMA
    stored = spark.createDataFrame([], columns).unionByName(seed)
    topics = ChangeLog(f"{folder}/topics", ["slug"], stored)
    info = ChangeLog(
        f"{folder}/contentinfo", ["content_id"], spark.createDataFrame([], stream.INFO_SCHEMA)
    )
    stream.topic_stream(messages, topics, info, f"{folder}/checkpoint", AS_OF).awaitTermination()
    return info.current().select(
        F.col("content_id").cast("bigint").alias("content_id"),
        "language",
        F.array_join("topics", ",").alias("topics"),
        "translated_en",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )
