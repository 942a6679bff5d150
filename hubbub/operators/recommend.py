"""Interactions, popularity rankings and member recommendations."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubbub.functions.constants import ENGAGEMENT_TYPES, EVENT_STRENGTH
from hubbub.functions.scores import half_even
from hubbub.functions.times import newer_than_months
from hubbub.operators.ordering import dense_ids
from hubbub.operators.products import BLOCK, best_products
from hubbub.session import ensure_checkpoint_dir

DEFAULT_COUNTRY = "us"
DEFAULT_LANGUAGE = "en"
DEFAULT_CLASS = "etc"


def strength(kind: Column, unknown_as: str | None = None) -> Column:
    """Interaction strength of an engagement type; null, or the given type's, when unknown."""
    value = F.lit(EVENT_STRENGTH[unknown_as]) if unknown_as else F.lit(None).cast("double")
    for name in ENGAGEMENT_TYPES:
        value = F.when(kind == name, F.lit(EVENT_STRENGTH[name])).otherwise(value)
    return value


def listed_contents(contents: DataFrame, filtering: DataFrame) -> DataFrame:
    """Published contents with a title and a filtering row."""
    listed = contents.where((F.col("visibility") == "publish") & F.col("message").isNotNull())
    return listed.join(filtering.select("content_id"), "content_id", "left_semi")


def articles(
    contents: DataFrame, users: DataFrame, accounts: DataFrame, filtering: DataFrame
) -> DataFrame:
    """Listed contents with title, place, language and class."""
    owners = users.select(F.col("user_id").alias("author_id"), "owner_account")
    places = accounts.select(
        F.col("account_id").alias("owner_account"), "country_code", "continent_code"
    )
    homes = owners.join(places, "owner_account", "left").drop("owner_account")
    listed = contents.where((F.col("visibility") == "publish") & F.col("message").isNotNull())
    return (
        listed.join(filtering.select("content_id", "language", "class"), "content_id")
        .join(homes, "author_id", "left")
        .select(
            "content_id",
            F.col("author_id").alias("author"),
            F.col("type").alias("content_type"),
            "created_at",
            F.col("message").alias("title"),
            F.coalesce("country_code", F.lit(DEFAULT_COUNTRY)).alias("country_code"),
            F.coalesce("continent_code", F.lit(DEFAULT_COUNTRY)).alias("continent_code"),
            F.coalesce("language", F.lit(DEFAULT_LANGUAGE)).alias("language"),
            F.coalesce("class", F.lit(DEFAULT_CLASS)).alias("class"),
        )
    )


def interactions(
    engagements: DataFrame,
    listed: DataFrame,
    as_of: datetime,
    months: int = 4,
    unknown_as: str | None = None,
) -> DataFrame:
    """Latest time and summed strength per (person, content) over the last months.

    Reports are left out. Engagements of an unknown type are ignored, or counted as the type
    ``unknown_as``. Only ``listed`` contents count; rows are combined per pair before that join.
    """
    recent = engagements.where(
        newer_than_months(engagements, "created_at", as_of, months)
        & ~F.col("type").eqNullSafe("report")
    )
    scored = recent.select(
        F.col("user_id").alias("person_id"),
        "content_id",
        F.col("created_at").alias("timestamp"),
        strength(F.col("type"), unknown_as).alias("event_strength"),
    ).where(F.col("event_strength").isNotNull())
    pairs = scored.groupBy("person_id", "content_id").agg(
        F.max("timestamp").alias("timestamp"), F.sum("event_strength").alias("event_strength")
    )
    return pairs.join(listed.select("content_id"), "content_id", "left_semi")


def min_interaction_users(pairs: DataFrame, min_contents: int = 4) -> DataFrame:
    """Interactions of people with at least ``min_contents`` distinct contents."""
    active = (
        pairs.groupBy("person_id")
        .agg(F.count(F.lit(1)).alias("contents"))
        .where(F.col("contents") >= min_contents)
    )
    return pairs.join(active.select("person_id"), "person_id", "left_semi")


def scaled_strength(pairs: DataFrame) -> DataFrame:
    """Adds ``scaled``: strength scaled to 0-1 per content over all people.

    People without an interaction count as strength 0, so the minimum is 0 unless everyone
    interacted. They are counted, not materialised.
    """
    ranges = pairs.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("_people"),
        F.min("event_strength").alias("_least"),
        F.max("event_strength").alias("_most"),
    )
    everyone = pairs.agg(F.countDistinct("person_id").alias("n")).scalar()
    low = F.when(F.col("_people") == everyone, F.col("_least")).otherwise(F.lit(0.0))
    scaled = F.try_divide(F.col("event_strength") - low, F.col("_most") - low)
    return (
        pairs.join(ranges, "content_id")
        .withColumn("scaled", F.coalesce(scaled, F.lit(0.0)))
        .drop("_people", "_least", "_most")
    )


def content_strength(pairs: DataFrame, article_rows: DataFrame) -> DataFrame:
    """One row per content with its attributes, summed strength and latest interaction.

    Interactions are summed per content before the join, so a popular content is one row by
    then. ``article_rows`` has one row per content.
    """
    per_content = pairs.groupBy("content_id").agg(
        F.max("timestamp").alias("timestamp"), F.sum("event_strength").alias("event_strength")
    )
    attributes = ("content_id", "title", "author", "country_code", "continent_code", "language")
    return per_content.join(article_rows.select(*attributes), "content_id")


def _scaled(contents: DataFrame, by: str) -> Column:
    """Strength scaled to 0-1 over the contents that have a ``by``; 0 when all are equal."""
    strength = F.col("event_strength")
    bounds = contents.where(F.col(by).isNotNull()).agg(
        F.struct(F.min(strength).alias("low"), F.max(strength).alias("high"))
    )
    limits = bounds.scalar()
    scaled = F.try_divide(strength - limits["low"], limits["high"] - limits["low"])
    return F.coalesce(scaled, F.lit(0.0))


def popularity(contents: DataFrame, by: str) -> DataFrame:
    """Contents of ``content_strength`` with a 0-1 score, listed by country or language.

    ``contents`` is read twice, for its bounds and its rows: pass saved rows.
    """
    columns = ("content_id", "title", by, "author", "timestamp", "event_strength")
    return contents.where(F.col(by).isNotNull()).select(
        *columns, _scaled(contents, by).alias("score")
    )


def default_feed(contents: DataFrame) -> DataFrame:
    """Country ranking followed by language ranking, the first row of each content kept.

    A content is in each list at most once, so its first row is the country one, or the language
    one where it has no country. That is decided row by row, without joining the lists.
    """
    keys = ("country_code", "language")

    def first(values: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col(by).isNotNull(), values[by]) for by in keys])

    listed = contents.where(F.col(keys[0]).isNotNull() | F.col(keys[1]).isNotNull())
    return listed.select(
        "content_id",
        "title",
        "timestamp",
        "event_strength",
        first({by: F.lit(by) for by in keys}).alias("model_key"),
        first({by: F.col(by) for by in keys}).alias("model_value"),
        half_even(first({by: _scaled(contents, by) for by in keys}), 4).alias("score"),
        "author",
    )


def session_features(pairs: DataFrame) -> DataFrame:
    """Flags for daytime (7 to 19 h) and weekend."""
    hour = F.hour("timestamp")
    return pairs.withColumns(
        {
            "daytime": ((hour > 6) & (hour < 20)).cast("int"),
            "weekend": F.weekday("timestamp").isin(5, 6).cast("int"),
        }
    )


def fit_factors(
    pairs: DataFrame,
    rank: int = 5,
    iterations: int = 10,
    regularisation: float = 0.1,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A low-rank model of interaction strength, with dictionaries of the numbers it uses.

    Returns ``(person_factors, content_factors, person_dict, content_dict)``; factors are ``(id,
    features)``. ``pairs`` is read several times: pass saved rows.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    people = dense_ids(pairs, "person_id", "user")
    items = dense_ids(pairs, "content_id", "content")
    coded = (
        pairs.join(people, "person_id")
        .join(items, "content_id")
        .select(
            F.col("user").cast("int").alias("user"),
            F.col("content").cast("int").alias("content"),
            F.col("event_strength").cast("float").alias("rating"),
        )
    )
    blocks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    als = ALS(
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user",
        itemCol="content",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        seed=seed,
        coldStartStrategy="drop",
    )
    fitted = als.fit(coded)
    return fitted.userFactors, fitted.itemFactors, people, items


def best_contents(person_factors: DataFrame, content_factors: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``user, content, score``: the ``k`` contents of largest score per person, found exactly."""
    queries = person_factors.select(F.col("id").alias("query"), F.col("features").alias("vector"))
    items = content_factors.select(F.col("id").alias("item"), F.col("features").alias("vector"))
    found = best_products(queries, items, k, block)
    return found.select(F.col("query").alias("user"), F.col("item").alias("content"), "score")


def member_recommendations(
    pairs: DataFrame,
    k: int = 10,
    people_wanted: DataFrame | None = None,
    rank: int = 5,
    iterations: int = 10,
    regularisation: float = 0.1,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Best ``k`` contents per person from a low-rank model, with the two id dictionaries.

    Returns ``(scores, person_dict, content_dict)``; scores are ``(user, content, score)``.
    ``people_wanted`` (one column ``person_id``) limits the scoring to some people, such as those
    with new interactions. ``pairs`` is read several times: pass saved rows.
    """
    persons, contents, people, items = fit_factors(pairs, rank, iterations, regularisation, seed)
    if people_wanted is not None:
        wanted = people.join(people_wanted.select("person_id"), "person_id", "left_semi")
        persons = persons.join(wanted.select(F.col("user").cast("int").alias("id")), "id", "left_semi")
    return best_contents(persons, contents, k), people, items


def checked_scores(scores: DataFrame, person_factors: DataFrame, content_factors: DataFrame) -> DataFrame:
    """``scores`` with ``rank`` and ``is_product``: whether a score is the product of the two factors."""
    order = Window.partitionBy("user").orderBy(F.col("score").desc(), "content")
    own = person_factors.select(F.col("id").alias("user"), F.col("features").alias("_p"))
    other = content_factors.select(F.col("id").alias("content"), F.col("features").alias("_c"))
    parts = F.zip_with("_p", "_c", lambda x, y: x.cast("double") * y.cast("double"))
    product = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return (
        scores.join(own, "user")
        .join(other, "content")
        .withColumn("is_product", F.abs(product - F.col("score")) <= 1e-9 * (1 + F.abs(product)))
        .withColumn("rank", F.row_number().over(order))
        .drop("_p", "_c")
    )
