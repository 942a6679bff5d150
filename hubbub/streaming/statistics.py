"""Creator, hashtag and user statistics kept up to date from changed contents alone.

A table of content states tells what a change replaces: the stored state is taken out of the totals and
the new one put in, as rows of sign -1 and +1. Totals are kept per group and day, so a window moves over
them without the contents; only the day in which the window begins is read from the states. Totals add
up under both signs. A largest or smallest value does not: where a row that held it is withdrawn and no
newer one takes its place, the groups concerned take it from the states again.

The later state of a content counts, of two with one time the one that comes later, so a late event changes
nothing. A deleted content keeps its time.
Every group carries the last batch that changed it, and states are written last: a batch repeated after
a failure finds what is left to do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hubbub.functions.text import hashtags
from hubbub.functions.times import moment, newer_than, utc
from hubbub.operators import stats
from hubbub.sources.sinks import merge_rows, read_table, replace_parts, touched_parts
from hubbub.streaming.refresh import drain, latest_states

COUNTS = ("like_count", "comment_count", "recast_count", "quote_count")


@dataclass(frozen=True)
class Totals:
    """How contents add up to one kind of totals.

    ``rows`` turns states, which carry ``_sign``, into rows with ``keys``, ``day``, the counts and the
    columns of ``largest`` and ``smallest``.
    """

    name: str
    keys: tuple[str, ...]
    time: str
    rows: Callable[[DataFrame], DataFrame]
    largest: tuple[str, ...] = ()
    smallest: tuple[str, ...] = ()

    @property
    def groups(self) -> list[str]:
        return [*self.keys, "day"]

    @property
    def extremes(self) -> tuple[str, ...]:
        return self.largest + self.smallest


def _creator_rows(states: DataFrame) -> DataFrame:
    return states.where(F.col("visibility") == "publish").withColumn("day", F.to_date("updated_at"))


def _hashtag_rows(states: DataFrame) -> DataFrame:
    tagged = states.where(F.col("created_at").isNotNull())
    return tagged.withColumn("name", F.explode("tags")).withColumn("day", F.to_date("created_at"))


def _user_rows(states: DataFrame) -> DataFrame:
    return states.where(F.col("created_at").isNotNull()).withColumn("day", F.to_date("created_at"))


CREATORS = Totals("creators", ("author_id", "type"), "updated_at", _creator_rows, ("updated_at",))
HASHTAGS = Totals(
    "hashtags", ("name", "author_id"), "created_at", _hashtag_rows, ("version", "updated_at"), ("created_at",)
)
USERS = Totals("users", ("author_id", "hashtags", "type"), "created_at", _user_rows)


def content_states(contents: DataFrame) -> DataFrame:
    """What the statistics need of each content."""
    version = F.col("version") if "version" in contents.columns else F.lit(None).cast("int")
    return contents.select(
        "content_id",
        "author_id",
        "type",
        "visibility",
        F.when(F.col("message").isNotNull(), hashtags(F.col("message"))).alias("tags"),
        "hashtags",
        *COUNTS,
        version.alias("version"),
        "created_at",
        "updated_at",
        "deleted",
    )


def _signed(kind: Totals, states: DataFrame) -> DataFrame:
    return kind.rows(states.where(~F.col("deleted")))


def _added(kind: Totals, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Signed rows added up: totals, extremes of what came and, as ``_gone_``, of what went."""
    sign = F.col("_sign")
    came = lambda c: F.when(sign > 0, F.col(c))
    went = lambda c: F.when(sign < 0, F.col(c))
    return rows.groupBy(*by).agg(
        F.sum(sign).alias("n"),
        *[F.sum(sign * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in COUNTS],
        *[F.max(came(c)).alias(f"_{c}") for c in kind.largest],
        *[F.min(came(c)).alias(f"_{c}") for c in kind.smallest],
        *[F.max(went(c)).alias(f"_gone_{c}") for c in kind.largest],
        *[F.min(went(c)).alias(f"_gone_{c}") for c in kind.smallest],
    )


def _empty(kind: Totals, states: DataFrame) -> DataFrame:
    rows = _added(kind, _signed(kind, states.limit(0).withColumn("_sign", F.lit(1).cast("bigint"))), kind.groups)
    return rows.select(
        *kind.groups, "n", *COUNTS, *[F.col(f"_{c}").alias(c) for c in kind.extremes], F.lit("").alias("mark")
    )


def _same(groups: Sequence[str], left: str, right: str) -> Column:
    match = F.lit(True)
    for g in groups:
        match &= F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return match


def apply_changes(kind: Totals, table: str, changes: DataFrame, states: DataFrame, mark: str) -> None:
    """Bring the totals in ``table`` up to date with signed ``changes``; ``states`` are those after them.

    Groups that carry ``mark`` have these changes already.
    """
    spark = changes.sparkSession
    delta = _added(kind, _signed(kind, changes), kind.groups)

    def next_state(stored: DataFrame) -> DataFrame:
        done = F.coalesce(F.col("s.mark") == mark, F.lit(False))
        joined = stored.alias("s").join(delta.alias("d"), _same(kind.groups, "s", "d"), "full")
        new = ~done & F.col("d.n").isNotNull()
        plus = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit(0)) + F.when(new, F.col(f"d.{c}")).otherwise(0)

        def extreme(c: str) -> Column:
            pick = F.greatest if c in kind.largest else F.least
            return pick(F.col(f"s.{c}"), F.when(new, F.col(f"d._{c}")))

        def stale(c: str) -> Column:
            gone, kept, came = F.col(f"d._gone_{c}"), F.col(f"s.{c}"), F.col(f"d._{c}")
            if c in kind.largest:
                return (gone >= kept) & (came.isNull() | (came < gone))
            return (gone <= kept) & (came.isNull() | (came > gone))

        again = F.lit(False)
        for c in kind.extremes:
            again |= F.coalesce(stale(c), F.lit(False))
        merged = joined.select(
            *[F.when(F.col("s.mark").isNotNull(), F.col(f"s.{g}")).otherwise(F.col(f"d.{g}")).alias(g) for g in kind.groups],
            plus("n").alias("n"),
            *[plus(c).alias(c) for c in COUNTS],
            *[extreme(c).alias(c) for c in kind.extremes],
            F.when(new, F.lit(mark)).otherwise(F.col("s.mark")).alias("mark"),
            (new & again).alias("_again"),
        )
        if not kind.extremes:
            return merged.drop("_again")
        return _with_extremes_read_again(kind, merged, states)

    replace_parts(spark, table, delta.select(*kind.groups), next_state)


def _with_extremes_read_again(kind: Totals, merged: DataFrame, states: DataFrame) -> DataFrame:
    """Extremes of the groups marked ``_again`` from the states of their days."""
    wanted = merged.where(F.col("_again") & (F.col("n") > 0)).select(*kind.groups)
    low, high = wanted.agg(F.min("day"), F.max("day")).first()
    if low is None:
        return merged.drop("_again")
    bounds = (F.col(kind.time) >= F.lit(low)) & (F.col(kind.time) < F.lit(high + timedelta(days=1)))
    rows = _signed(kind, states.where(bounds).withColumn("_sign", F.lit(1).cast("bigint")))
    rows = rows.alias("r").join(wanted.alias("w"), _same(kind.groups, "r", "w"), "left_semi")
    fresh = _added(kind, rows, kind.groups).alias("f")
    joined = merged.alias("m").join(fresh, _same(kind.groups, "m", "f") & F.col("m._again"), "left")
    return joined.select(
        *[
            F.when(F.col("m._again"), F.col(f"f._{c}")).otherwise(F.col(f"m.{c}")).alias(c)
            if c in kind.extremes
            else F.col(f"m.{c}").alias(c)
            for c in merged.columns
            if c != "_again"
        ]
    )


def refresh_statistics(
    contents: DataFrame,
    checkpoint: str,
    prefix: str = "",
    kinds: Sequence[Totals] = (CREATORS, HASHTAGS, USERS),
    buckets: int | None = None,
) -> StreamingQuery:
    """Bring the tables behind ``current_creator_stats`` and its siblings up to date.

    ``contents`` streams states of contents in any order; a row whose ``deleted`` is true withdraws a
    content. Rows without an id or a time of update are left out. ``buckets`` is the number of parts
    of tables that do not exist yet.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = content_states(latest_states(batch)).persist()
        known = f"{prefix}content_states"
        if not spark.catalog.tableExists(known):
            merge_rows(latest.limit(0), known, ["content_id"], "groups", buckets=buckets)
        before = touched_parts(latest.select("content_id"), known).alias("b")
        pairs = latest.alias("a").join(before, F.col("a.content_id") == F.col("b.content_id"), "left")
        later = pairs.where(F.col("b.updated_at").isNull() | (F.col("a.updated_at") >= F.col("b.updated_at")))
        came = later.select("a.*", F.lit(1).cast("bigint").alias("_sign"))
        went = later.where(F.col("b.content_id").isNotNull()).select("b.*", F.lit(-1).cast("bigint").alias("_sign"))
        changes = came.unionByName(went).persist()
        stored = read_table(spark, known)
        ids = came.select("content_id")
        after = stored.join(ids, "content_id", "left_anti").unionByName(came.drop("_sign"))
        run = spark.read.text(f"{checkpoint}/metadata").first()[0]
        try:
            for kind in kinds:
                table = f"{prefix}{kind.name}_by_day"
                if not spark.catalog.tableExists(table):
                    merge_rows(_empty(kind, latest), table, kind.groups, "groups", buckets=buckets)
                apply_changes(kind, table, changes, after, f"{run}/{number}")
            merge_rows(latest, known, ["content_id"], "later", order=["updated_at"])
        finally:
            changes.unpersist()
            latest.unpersist()

    return drain(contents, apply, checkpoint)


def totals_in_window(spark: SparkSession, kind: Totals, as_of: datetime, days: float, prefix: str = "") -> DataFrame:
    """Totals per group of ``kind`` over ``days`` before ``as_of``: whole days, and a part of the first."""
    states, table = f"{prefix}content_states", f"{prefix}{kind.name}_by_day"
    for name in (states, table):
        spark.catalog.refreshTable(name)
    begin = utc(as_of) - timedelta(days=days)
    whole = read_table(spark, table).where((F.col("day") > F.lit(begin.date())) & (F.col("n") > 0))
    known = read_table(spark, states)
    end = datetime(begin.year, begin.month, begin.day) + timedelta(days=1)
    edge = known.where(newer_than(known, kind.time, as_of, days) & (F.col(kind.time) < moment(known, kind.time, end)))
    rows = _added(kind, _signed(kind, edge.withColumn("_sign", F.lit(1).cast("bigint"))), kind.groups)
    first = rows.select(*kind.groups, "n", *COUNTS, *[F.col(f"_{c}").alias(c) for c in kind.extremes])
    both = whole.drop("mark").unionByName(first)
    return both.groupBy(*kind.keys).agg(
        F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in COUNTS],
        *[F.max(c).alias(c) for c in kind.largest],
        *[F.min(c).alias(c) for c in kind.smallest],
    )


_NAMES = {"like_count": "liked_count", "comment_count": "commented_count", "recast_count": "recasted_count", "quote_count": "quoted_count"}


def current_creator_stats(
    spark: SparkSession,
    users: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    days: float = 30.0,
    prefix: str = "",
    **parameters,
) -> DataFrame:
    """``creator_stats`` at ``as_of``, from the refreshed tables."""
    per_type = totals_in_window(spark, CREATORS, as_of, days, prefix)
    per_type = per_type.withColumnsRenamed({"n": "type_count", **_NAMES})
    return stats.creators_from_totals(per_type, users, accounts, as_of, **parameters)


def current_hashtag_stats(
    spark: SparkSession, as_of: datetime, days: float = 14.0, prefix: str = "", **parameters
) -> DataFrame:
    """``hashtag_stats`` at ``as_of``, from the refreshed tables."""
    per_author = totals_in_window(spark, HASHTAGS, as_of, days, prefix)
    per_author = per_author.withColumnsRenamed({"n": "contribution_count", **_NAMES})
    return stats.hashtags_from_contributions(per_author, as_of, **parameters)


def current_user_stats(
    spark: SparkSession, users: DataFrame, as_of: datetime, days: float = 14.0, prefix: str = ""
) -> DataFrame:
    """``user_stats`` at ``as_of``, from the refreshed tables."""
    per_type = totals_in_window(spark, USERS, as_of, days, prefix).withColumnRenamed("n", "type_count")
    return stats.users_from_hashtags(stats.user_hashtags_from_totals(per_type), users)
