"""A trained language tag: naive Bayes over letter trigrams, as a table of whole-number weights.

Words are runs of letters, lower-cased; the trigrams of a word are those of the word between two spaces. The
weight of a trigram in a language is the logarithm of its smoothed share there, in whole thousandths, so sums
are exact in any order. In training words are counted per language before they are taken apart. In tagging the
common trigrams, a bounded number, go to every task: words made of these are scored where they are read, once per
block of texts, and a text sends one row for all of them. Other words are counted per text and shuffled to their
scores, so the result is exact with any number of trigrams.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.functions.text import UNKNOWN_LANGUAGE, has_thai
from hubbub.session import saved

SCALE = 1000
SMOOTHING = 1
#: Trigrams that every task may hold with their weights.
COMMON = 500_000
#: Texts that are scored together.
ROWS_AT_ONCE = 256


def letter_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def trigrams(word: Column) -> Column:
    """As many trigrams as the word has letters."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(padded, i, F.lit(3)))


def trigram_counts(rows: DataFrame, text: str, language: str) -> DataFrame:
    """``language, gram, count`` over all texts with a known language."""
    known = rows.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    words = (
        known.select(F.col(language).alias("language"), F.explode(letter_words(F.col(text))).alias("word"))
        .groupBy("language", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grams = words.select("language", "n", F.explode(trigrams(F.col("word"))).alias("gram"))
    return grams.groupBy("language", "gram").agg(F.sum("n").alias("count"))


def trigram_weights(counts: DataFrame) -> tuple[DataFrame, list[str]]:
    """``gram, weights``, one weight per language, and the languages in the order of the weights.

    ``counts`` is read more than once: pass saved rows. The languages, and one number for each, come
    to the driver.
    """
    totals = sorted(counts.groupBy("language").agg(F.sum("count")).collect())
    languages = [r[0] for r in totals]
    by_gram = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("language", "count"))).alias("by"))
    kinds = by_gram.agg(F.count(F.lit(1))).scalar()

    def weight(language: str, total: int) -> Column:
        own = F.coalesce(F.try_element_at("by", F.lit(language)), F.lit(0)) + SMOOTHING
        return F.round(F.log(own / (F.lit(total) + SMOOTHING * F.col("kinds"))) * SCALE).cast("long")

    table = by_gram.withColumn("kinds", kinds)
    return table.select("gram", F.array(*[weight(*r) for r in totals]).alias("weights")), languages


def _table(common: pa.Table, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams as numbers, 21 bits a letter, in ascending order, and their weights."""
    letters = np.frombuffer("".join(common.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, 3)
    numbers = letters[:, 0] << 42 | letters[:, 1] << 21 | letters[:, 2]
    weights = np.array(common.column("weights").to_pylist(), dtype=np.int64).reshape(-1, languages)
    order = np.argsort(numbers)
    return numbers[order], weights[order]


def _scorer(shared):
    """A function for the workers, nested so that they need no copy of this package."""
    step = ROWS_AT_ONCE

    def of_words(words: list[str], known: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed weights of each word, and whether all its trigrams are known."""
        letters = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        middle = np.flatnonzero(letters != 32)
        word = (np.cumsum(letters == 32) - 1)[middle]
        gram = letters[middle - 1] << 42 | letters[middle] << 21 | letters[middle + 1]
        at = np.minimum(np.searchsorted(known, gram), max(len(known) - 1, 0))
        met = known[at] == gram if len(known) else np.zeros(len(gram), bool)
        sums = [np.bincount(word[met], weights[at[met], i], len(words)) for i in range(weights.shape[1])]
        return np.stack(sums, axis=1), np.bincount(word[~met], minlength=len(words)) == 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                lengths = some.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                if not lengths.any():
                    continue
                coded = some.column(1).flatten().dictionary_encode()
                row, code = np.repeat(np.arange(len(some)), lengths), coded.indices.to_numpy().astype(np.int64)
                sums, whole = of_words(coded.dictionary.to_pylist(), known, weights)
                own = whole[code]
                scores = [np.bincount(row[own], sums[code[own], i], len(some)) for i in range(sums.shape[1])]
                asked = np.unique(row[own])
                pair, n = np.unique(row[~own] * len(sums) + code[~own], return_counts=True)
                keys = some.column(0).take(pa.array(np.append(asked, pair // len(sums))))
                names = pa.concat_arrays([pa.nulls(len(asked), pa.string()), coded.dictionary.take(pa.array(pair % len(sums)))])
                counts = pa.array(np.append(np.zeros(len(asked), np.int64), n), pa.int64())
                lists = [*np.stack(scores, axis=1)[asked].astype(np.int64), *[None] * len(pair)]
                yield pa.RecordBatch.from_arrays(
                    [keys, names, counts, pa.array(lists, pa.list_(pa.int64()))], names=["_key", "word", "n", "scores"]
                )

    return run


def trained_language_tags(rows: DataFrame, weights: DataFrame, languages: list[str], key: str, text: str) -> DataFrame:
    """``key, language`` of each row: the language of largest total weight, the first of equal ones.

    ``key`` tells rows apart. A text with a Thai letter is ``th``. Trigrams that no language has seen
    say nothing; a text without any other is ``n/a``, as are empty and null texts.
    """
    thai = has_thai(F.col(text))
    if not languages:
        return rows.select(key, F.when(thai, "th").otherwise(F.lit(UNKNOWN_LANGUAGE)).alias("language"))
    n = range(len(languages))
    # Shares of a language sum to 1, so these are some COMMON trigrams at most, whatever the texts.
    least = math.floor(SCALE * math.log(len(languages) / COMMON)) + 1
    common = weights.where((F.array_max("weights") >= least) & (F.length("gram") == 3)).select("gram", "weights").toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(_table(common, len(languages)))
    kind = rows.schema[key].dataType.simpleString()
    words = rows.select(key, letter_words(F.col(text)).alias("words"))
    met = saved(words.mapInArrow(_scorer(shared), f"_key {kind}, word string, n long, scores array<long>"))
    scored = met.where(F.col("word").isNull()).select("_key", *[F.get("scores", F.lit(i)).alias(f"w{i}") for i in n])
    # Words with another trigram are scored once each, and meet the texts by a shuffle.
    counted = met.where(F.col("word").isNotNull()).select("_key", "word", "n")
    grams = counted.select("word").distinct().select("word", F.explode(trigrams(F.col("word"))).alias("gram"))
    of_word = grams.join(weights, "gram").groupBy("word").agg(*[F.sum(F.get("weights", F.lit(i))).alias(f"w{i}") for i in n])
    others = counted.join(of_word, "word").select("_key", *[(F.col("n") * F.col(f"w{i}")).alias(f"w{i}") for i in n])
    totals = scored.unionByName(others).groupBy("_key").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in n])
    ranked = [F.struct(F.col(f"w{i}").alias("w"), F.lit(-i).alias("rank"), F.lit(languages[i]).alias("language")) for i in n]
    best = F.array_max(F.array(*ranked))["language"]
    found = totals.select("_key", best.alias("_best"))
    joined = rows.select(key, thai.alias("_thai")).join(found, F.col(key) == F.col("_key"), "left")
    return joined.select(
        key, F.when(F.col("_thai"), "th").otherwise(F.coalesce("_best", F.lit(UNKNOWN_LANGUAGE))).alias("language")
    )
