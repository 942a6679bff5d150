"""Language and topic tags of messages, and the topic taxonomy."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.functions.scores import half_even
from hubbub.functions.text import (
    classifiable,
    clean_message,
    language_tag,
    token_count,
    topic_slugs,
)
from hubbub.functions.times import utc
from hubbub.operators.products import best_products
from hubbub.operators.vectors import text_vectors
from hubbub.session import saved

LABELS_AT_ONCE = 4_096
NO_TOPIC = "etc"


def chosen_category(categories: Column, most_confident: bool = False) -> Column:
    """One category path of several: the last one, or the one with the highest confidence.

    ``categories`` is an array of ``(name, confidence)``.
    """
    if most_confident:
        return F.array_max(
            F.transform(categories, lambda c: F.struct(c["confidence"], c["name"]))
        )["name"]
    return F.when(F.size(categories) > 0, F.element_at(categories, -1)["name"])


def tag_messages(messages: DataFrame) -> DataFrame:
    """Language, topic slugs and translation of each message.

    Input columns: ``content_id, message, updated_at, category`` (path from the category
    service), ``translated_en`` and ``detected_language`` (from the translation service). English
    messages are classified from their own text, others from the translation; either needs at
    least 21 tokens after cleaning. Slugs are null otherwise.
    """
    tagged = messages.withColumns(
        {
            "_clean": clean_message(F.col("message")),
            "_translation": clean_message(F.col("translated_en")),
        }
    ).withColumn("_language", language_tag(F.col("message"), F.col("_clean")))
    own = F.col("_language") == "en"
    translation = F.col("_translation")
    ready = F.when(own, classifiable(F.col("_clean"))).otherwise(
        F.coalesce(classifiable(translation), F.lit(False))
    )
    has_topic = ready & F.col("category").isNotNull()
    return tagged.select(
        "content_id",
        F.when(own, F.col("_language"))
        .otherwise(F.coalesce("detected_language", "_language"))
        .alias("language"),
        F.when(has_topic, topic_slugs(F.col("category"))).alias("slugs"),
        F.when(~own & ready, translation).alias("translated_en"),
        "updated_at",
    )


def new_topic_id(slug: Column) -> Column:
    """Stable id of a topic not stored yet: 24 hex digits."""
    return F.substring(F.md5(slug.cast("binary")), 1, 24)


def topic_taxonomy(paths: DataFrame, existing: DataFrame) -> DataFrame:
    """Topics touched by the category paths, with their parents and children.

    ``paths`` has ``slugs`` and ``updated_at``. Neighbours in a path become parent and child;
    stored links are kept and new ones added, ids are resolved against stored and new topics.
    The arrays are as long as the taxonomy is wide, not as the data is long.
    """
    # The outer form keeps the optimizer from evaluating ``slugs`` a second time as a filter.
    steps = paths.select(
        F.posexplode_outer("slugs").alias("position", "slug"), "slugs", "updated_at"
    ).where(F.col("slug").isNotNull())
    parent = F.when(F.col("position") > 0, F.get("slugs", F.col("position") - 1))
    child = F.get("slugs", F.col("position") + 1)
    touched = steps.groupBy("slug").agg(
        F.min("updated_at").alias("_first"),
        F.max("updated_at").alias("_latest"),
        F.collect_set(parent).alias("_parents"),
        F.collect_set(child).alias("_children"),
    )
    no_slugs = F.array().cast("array<string>")
    merged = touched.join(existing, "slug", "left").select(
        "slug",
        F.coalesce("topic_id", new_topic_id(F.col("slug"))).alias("topic_id"),
        "parents",
        "children",
        F.array_sort(
            F.array_union(F.coalesce("parents_slug", no_slugs), "_parents")
        ).alias("parents_slug"),
        F.array_sort(
            F.array_union(F.coalesce("children_slug", no_slugs), "_children")
        ).alias("children_slug"),
        F.coalesce("created_at", "_first").alias("created_at"),
        F.col("_latest").alias("updated_at"),
    )

    def ends(slugs: str, up: bool) -> Column:
        return F.transform(slugs, lambda s: F.struct(F.lit(up).alias("up"), s.alias("to")))

    links = merged.select(
        "*",
        F.explode_outer(F.concat(ends("parents_slug", True), ends("children_slug", False))).alias(
            "_link"
        ),
    ).select("*", F.col("_link.up").alias("_up"), F.col("_link.to").alias("_to"))
    # A slug that is not stored has the id made from it, so only stored ids are looked up.
    stored = existing.select(F.col("slug").alias("_to"), F.col("topic_id").alias("_stored"))
    node = F.struct(
        F.coalesce("_stored", new_topic_id(F.col("_to"))).alias("_id"), F.col("_to").alias("slug")
    )
    no_nodes = F.array().cast("array<struct<_id:string,slug:string>>")

    def joined(column: str, found: Column) -> Column:
        linked = F.collect_set(F.when(found, node))
        return F.array_sort(
            F.array_union(F.coalesce(F.first(column), no_nodes), linked)
        ).alias(column)

    kept = ("parents_slug", "children_slug", "created_at", "updated_at")
    return (
        links.join(stored, "_to", "left")
        .groupBy("topic_id", "slug")
        .agg(
            joined("parents", F.col("_up")),
            joined("children", ~F.col("_up")),
            *[F.first(c).alias(c) for c in kept],
        )
    )


def content_topics(classified: DataFrame, topics: DataFrame, as_of: datetime) -> DataFrame:
    """Content info rows: language, topic ids in path order, translation.

    ``topics`` is null for a content without topics.
    """
    ids = topics.select("slug", "topic_id")
    steps = classified.select("content_id", F.posexplode("slugs").alias("position", "slug"))
    paths = (
        steps.join(ids, "slug")
        .groupBy("content_id")
        .agg(F.array_sort(F.collect_list(F.struct("position", "topic_id"))).alias("_path"))
    )
    # Only ids are exploded and regrouped; each text meets its topics once.
    return classified.join(paths, "content_id", "left").select(
        "content_id",
        "language",
        F.col("_path.topic_id").alias("topics"),
        "translated_en",
        F.lit(utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f"))
        .cast("timestamp_ntz")
        .alias("updated_at"),
    )


def untagged(filtering: DataFrame) -> DataFrame:
    """All filtering rows that have no class yet."""
    return filtering.where(F.col("class").isNull())


def _best_of(rows: list):
    """A function that betters the best (topic, score) so far by the labels of ``rows``."""
    names = np.array([row["topic"] for row in rows], dtype=object)
    matrix = np.array([row["embedding"] for row in rows], dtype=float).T

    @F.pandas_udf("struct<topic:string, score:double>")
    def best(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for batch, before in batches:
            topic = before["topic"].to_numpy(dtype=object, copy=True)
            score = before["score"].to_numpy(dtype=float, copy=True)
            score[np.isnan(score)] = -np.inf
            given = np.flatnonzero(batch.notna().to_numpy())
            if len(given):
                products = np.stack(batch.iloc[given].to_numpy()).astype(float) @ matrix
                place, top = products.argmax(axis=1), products.max(axis=1)
                known = np.array([t is not None for t in topic[given]])
                earlier = np.array([bool(k) and n < t for k, n, t in zip(known, names[place], topic[given])])
                better = (top > score[given]) | ~known | ((top == score[given]) & earlier)
                topic[given[better]], score[given[better]] = names[place[better]], top[better]
            yield pd.DataFrame({"topic": topic, "score": score})

    return best


def _matched_in_blocks(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """``vectors`` with ``_best``, by exact products with blocks of labels."""
    numbered = saved(labels.orderBy("topic").withColumn("item", F.monotonically_increasing_id()))
    rows = saved(vectors.withColumn("_row", F.monotonically_increasing_id()))
    found = best_products(
        rows.where(F.col("embedding").isNotNull()).select(F.col("_row").alias("query"), F.col("embedding").alias("vector")),
        numbered.select("item", F.col("embedding").alias("vector")),
        k=1,
        block=LABELS_AT_ONCE,
    )
    best = found.join(numbered.select("item", "topic"), "item").select(
        F.col("query").alias("_row"), F.struct("topic", "score").alias("_best")
    )
    return rows.join(best, "_row", "left").drop("_row")


def embedding_topics(
    vectors: DataFrame, topic_vectors: DataFrame, threshold: float = 0.15
) -> DataFrame:
    """The topic with the largest dot product for each vector, as ``class`` and ``score``.

    ``vectors`` has ``embedding`` and may have a cleaned ``message``; ``topic_vectors`` has
    ``topic`` and ``embedding``, any number of rows. Scores under the threshold, and messages of at
    most one token, are ``etc`` with 0; of equal scores the first topic counts. Up to
    ``LABELS_AT_ONCE`` labels are one matrix in every task. More are blocks of that size, ordered by
    length: a vector goes to the blocks that can hold its best label, and to no others.
    """
    labels = topic_vectors.select(F.col("topic").cast("string").alias("topic"), "embedding").where(
        F.col("topic").isNotNull() & F.col("embedding").isNotNull()
    )
    some = labels.limit(LABELS_AT_ONCE + 1).collect()
    if len(some) > LABELS_AT_ONCE:
        matched = _matched_in_blocks(vectors, labels)
    else:
        none = F.lit(None).cast("struct<topic:string, score:double>")
        best = _best_of(sorted(some, key=lambda row: row["topic"]))(F.col("embedding"), none) if some else none
        matched = vectors.withColumn("_best", best)
    clear = F.col("_best.score") >= threshold
    if "message" in vectors.columns:
        clear = clear & (token_count(F.col("message")) > 1)
    return matched.select(
        *[c for c in vectors.columns if c != "embedding"],
        F.when(clear, F.col("_best.topic"))
        .otherwise(F.lit(NO_TOPIC))
        .alias("class"),
        F.when(clear, half_even(F.col("_best.score"), 2)).otherwise(F.lit(0.0)).alias("score"),
    )


def text_topics(messages: DataFrame, labels: DataFrame, model: DataFrame, key: str, threshold: float = 0.15) -> DataFrame:
    """Topics of messages from their text alone, as ``class`` and ``score``; see ``embedding_topics``.

    ``messages`` has ``message``, cleaned, and ``key``; ``labels`` has ``topic`` and ``words`` that describe it,
    one row per topic. Both get their vectors by ``model`` (of ``fit_vectors``). Messages without a vector are ``etc``.
    """
    described = text_vectors(labels.select("topic", "words"), model, "topic", "words").select("topic", "embedding")
    return embedding_topics(text_vectors(messages, model, key, "message"), described, threshold)
