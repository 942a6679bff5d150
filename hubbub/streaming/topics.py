"""Tagging contents as they are created or changed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hubbub.operators.ordering import first_per_key
from hubbub.operators.topics import chosen_category, content_topics, tag_messages, topic_taxonomy
from hubbub.sources.schemas import CHANGE_EVENT
from hubbub.streaming.changelog import ChangeLog
from hubbub.streaming.refresh import drain

TOPIC_SCHEMA = (
    "topic_id string, slug string, parents array<struct<_id:string,slug:string>>, "
    "children array<struct<_id:string,slug:string>>, parents_slug array<string>, "
    "children_slug array<string>, created_at timestamp, updated_at timestamp"
)
INFO_SCHEMA = (
    "content_id string, language string, topics array<string>, translated_en string, "
    "updated_at timestamp"
)


def read_change_events(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """Change events from a folder of JSON lines."""
    return (
        spark.readStream.schema(CHANGE_EVENT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Change events from JSON text."""
    return lines.select(F.from_json(column, CHANGE_EVENT).alias("event")).select("event.*")


def event_messages(events: DataFrame, most_confident: bool = False) -> DataFrame:
    """The message of each insert or update event, with what the remote services added.

    Where the service lists several categories, one is chosen: the last, or the most confident.
    """
    document = "detail.fullDocument"
    return events.where(F.col(f"{document}._id").isNotNull()).select(
        F.col(f"{document}._id").alias("content_id"),
        F.col(f"{document}.payload.message").alias("message"),
        F.to_timestamp(f"{document}.updatedAt").alias("updated_at"),
        F.coalesce(
            f"{document}.category", chosen_category(F.col(f"{document}.categories"), most_confident)
        ).alias("category"),
        F.col(f"{document}.translatedEN").alias("translated_en"),
        F.col(f"{document}.detectedLanguage").alias("detected_language"),
    )


def with_news(messages: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """A stream of ``messages`` that also says which keys are new.

    Three kinds of rows share the ``key`` column: ``event`` rows are the messages; a ``new`` row comes
    with the first batch that has a key; ``known`` rows are those of the stream ``known``, keys that
    were there before the first batch. What has been seen is keyed state of the query, one entry per
    key, which a batch looks up for its own keys alone.
    """
    kind = lambda rows, name: rows.withColumn("_kind", F.lit(name))
    keys = messages.select(key).where(F.col(key).isNotNull())
    every = keys.unionByName(known.select(key))
    new = every.dropDuplicates([key])
    return (
        kind(messages, "event")
        .unionByName(kind(new, "new"), allowMissingColumns=True)
        .unionByName(kind(known.select(key), "known"), allowMissingColumns=True)
    )


def news_of(batch: DataFrame, key: str) -> DataFrame:
    """The messages of a batch of ``with_news`` whose key is new."""
    events = batch.where(F.col("_kind") == "event").drop("_kind")
    new = batch.where(F.col("_kind") == "new").select(key)
    known = batch.where(F.col("_kind") == "known").select(key)
    return events.join(new.join(known, key, "left_anti"), key, "left_semi")


def topic_stream(
    messages: DataFrame,
    topics: ChangeLog,
    contentinfo: ChangeLog,
    checkpoint: str,
    as_of: datetime,
) -> StreamingQuery:
    """Tag each new content once and keep taxonomy and content info up to date.

    Events count whatever their age. Of several events of a content in one batch the earliest is
    taken. Contents of earlier batches are known from the query's keyed state, those present before
    the stream from the seed of ``contentinfo``, read once; its other rows are never read. The query
    stops once the available events are done.
    """

    def tag(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        order = [F.col("updated_at"), F.col("message")]
        fresh = first_per_key(news_of(batch, "content_id"), ["content_id"], order)
        tagged = tag_messages(fresh).persist()
        try:
            stored = topics.current(before=number)
            touched = topic_taxonomy(tagged, stored)
            topics.write(touched, number)
            info = content_topics(tagged, topics.current(before=number + 1), as_of)
            contentinfo.write(
                info.withColumn("updated_at", F.col("updated_at").cast("timestamp")), number
            )
        finally:
            tagged.unpersist()
            batch.unpersist()

    return drain(with_news(messages, "content_id", contentinfo.seed()), tag, checkpoint)
