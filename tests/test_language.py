"""The trained language tag against the word lists and a plain computation."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from hubbub.functions import text
from hubbub.operators import language

SF = "/root/testdata/sf0.01"


def grams_of(message):
    words = re.findall(r"[^\W\d_]+", (message or "").lower())
    return Counter(f" {w} "[i : i + 3] for w in words for i in range(len(w)))


def test_equals_a_plain_computation(spark):
    rows = [
        (1, "The quick brown fox, the lazy dog", "en"), (2, "Der schnelle braune Fuchs; der faule Hund", "de"),
        (3, "le renard brun et le chien", "fr"), (4, None, "en"), (5, "", "de"), (6, "no language given", None), (7, "l'été à l'ombre", "fr"),
    ]
    asked = [(10, "the dog"), (11, "der Hund"), (12, "le chien"), (13, None), (14, "1234 !!"), (15, "ζζζ"), (16, "สวัสดี the"), (17, "a"), (18, "dog " * 3000)]
    train = spark.createDataFrame(rows, "id long, message string, lang string")
    weights, languages = language.trigram_weights(language.trigram_counts(train, "message", "lang").persist())
    found = language.trained_language_tags(spark.createDataFrame(asked, "id long, message string"), weights, languages, "id", "message")
    counts = {}
    for _, message, lang in rows:
        if lang and message is not None:
            counts.setdefault(lang, Counter()).update(grams_of(message))
    every = set().union(*counts.values())
    weight = {
        (lang, g): round(math.log((c[g] + 1) / (sum(c.values()) + len(every))) * 1000) for lang, c in counts.items() for g in every
    }
    expected = {}
    for key, message in asked:
        own = {g: n for g, n in grams_of(message).items() if g in every}
        scores = [(-sum(n * weight[lang, g] for g, n in own.items()), lang) for lang in sorted(counts)]
        expected[key] = "th" if message and "ส" in message else min(scores)[1] if own else "n/a"
    assert {r["id"]: r["language"] for r in found.collect()} == expected
    assert expected[10] == "en" and expected[11] == "de" and expected[12] == "fr" and expected[15] == "n/a"


def test_no_training_rows(spark):
    none = spark.createDataFrame([], "id long, message string, lang string")
    weights, languages = language.trigram_weights(language.trigram_counts(none, "message", "lang"))
    asked = spark.createDataFrame([(1, "some words")], "id long, message string")
    found = language.trained_language_tags(asked, weights, languages, "id", "message").collect()
    assert languages == [] and [tuple(r) for r in found] == [(1, "n/a")]


def test_better_than_word_lists_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL")
    train, held = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    weights, languages = language.trigram_weights(language.trigram_counts(train, "text", "lang").persist())
    tagged = language.trained_language_tags(held, weights, languages, "doc_id", "text")
    share = lambda df: df.join(held.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0]
    lists = held.select("doc_id", text.language_tag(F.col("text")).alias("language"))
    trained = share(tagged)
    assert trained > 0.95 and trained > share(lists)


def test_rare_trigrams_and_repeated_keys(spark, monkeypatch):
    rows = [(1, "the dog the fox", "en"), (2, "der hund der fuchs", "de"), (3, "une été 𝒜𝒷 x", "fr")]
    train = spark.createDataFrame(rows, "id long, message string, lang string")
    weights, languages = language.trigram_weights(language.trigram_counts(train, "message", "lang").persist())
    asked = [(i % 40, m) for i, m in enumerate(["the dog", "der fuchs der", "𝒜𝒷", "été", "zz qq", "", None, "dog hund der der"] * 10)]
    asked = spark.createDataFrame([*asked, (None, "the fox")], "id long, message string")
    tags = lambda: sorted(map(str, language.trained_language_tags(asked, weights, languages, "id", "message").collect()))
    every = tags()
    for some in (40, 1):  # few trigrams, and none, are common
        monkeypatch.setattr(language, "COMMON", some)
        assert tags() == every


def test_common_words_are_not_shuffled_one_by_one(spark, monkeypatch):
    rows = [(i, "the quick brown fox", "en") for i in range(40)] + [(i, "der schnelle fuchs", "de") for i in range(40, 80)]
    train = spark.createDataFrame(rows, "id long, message string, lang string")
    weights, languages = language.trigram_weights(language.trigram_counts(train, "message", "lang").persist())
    kept, save = [], language.saved
    monkeypatch.setattr(language, "saved", lambda df: kept.append(save(df)) or kept[-1])
    language.trained_language_tags(train, weights, languages, "id", "message").collect()
    assert kept[0].count() == 80 and kept[0].where("word IS NOT NULL").count() == 0
