"""From raw documents to token ids, in stages that are each written before the next one reads.

Every stage takes what its predecessor kept. Rows with a null ``doc_id`` pass the near-duplicate stage,
as nothing can refer to them; null texts are empty texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubbub.llm import bpe, decontaminate, minhash, quality, toxicity
from hubbub.llm.common import held_out, table, written
from hubbub.llm.queries import QUALITY_CUT, TOXIC_CUT
from hubbub.session import tune


#: Documents for which a further output file is worth while.
DOCUMENTS_PER_FILE = 2_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality classifier rejects."""
    tune(spark)
    model = quality.fitted(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), ~held_out(F.col("doc_id")))
    return quality.scored(docs, model, score="_quality").where(F.col("_quality") >= QUALITY_CUT).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without toxic documents."""
    tune(spark)
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out(F.col("doc_id")))
    return toxicity.scored(docs, model, score="_toxicity").where(F.col("_toxicity") < TOXIC_CUT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    An id that stands for several texts keeps those that the operator keeps, one row for each set of
    word runs.
    """
    tune(spark)
    kept = minhash.clustered(docs, content="_set").where("kept").select(F.col("doc_id").alias("_kept_id"), "_set").distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    often = named.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_often_id"))
    once = named.join(often, named["doc_id"] == often["_often_id"], "left_anti")
    single = once.join(kept, once["doc_id"] == kept["_kept_id"], "left_semi")
    again = minhash.with_content(named.join(often, named["doc_id"] == often["_often_id"], "left_semi"), "_own_set")
    same = (again["doc_id"] == kept["_kept_id"]) & again["_own_set"].eqNullSafe(kept["_set"])
    several = again.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_own_set"]).drop("_own_set")
    out = single.unionByName(several).unionByName(docs.where(F.col("doc_id").isNull()))
    return out.coalesce(1 + docs.count() // DOCUMENTS_PER_FILE)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages; documents that are mostly benchmark go as a whole."""
    tune(spark)
    out = decontaminate.removed(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    if "n_chars" not in docs.columns:
        return out
    n_chars = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return out.withColumn("n_chars", n_chars)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked to decode to the text's bytes."""
    tune(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encoded_checked(
        docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, most_kept=120_000
    )
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "intact")


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", remove_benchmarks),
    ("byte_level_bpe", to_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents", "*")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
