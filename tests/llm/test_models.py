import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hubbub.llm import langid, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def area(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def judged(spark, name, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.queries()[name](spark, SF).where("held_out").join(labels, "doc_id").toPandas()
    return rows["score"].to_numpy(), rows[label].to_numpy(), rows["predicted"].to_numpy()


def test_quality_held_out(spark):
    score, label, predicted = judged(spark, "op5_quality", "quality")
    assert area(score, label) > 0.98 and ((predicted == 1) & (label == 1)).sum() > 0.98 * (label == 1).sum()


def test_toxicity_held_out(spark):
    score, label, predicted = judged(spark, "op4_toxicity", "toxic")
    assert area(score, label) > 0.9 and (predicted == label).mean() > 0.95


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.queries()["op10_language_id"](spark, SF).where("held_out").join(docs, "doc_id")
    assert rows.where("lang = lang_pred").count() > 0.99 * rows.count()


def test_gradients():
    kind, raw = toxicity.word_kind(), [b"some words here and there", b"x", b"", b"more of the same " * 30]
    inputs = toxicity.Inputs(kind, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    first, length, text = inputs.windows()
    assert sorted(set(text.tolist())) == [0, 1, 3] and length.max() == toxicity.WINDOW
    net = toxicity.Network(1)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    logits = lambda: net.forward(net.gates(inputs, net.chars(inputs)), first, length).sum()
    kept, chars = [], net.chars(inputs)
    net.forward(net.gates(inputs, chars), first, length, kept)
    grads = net.backward(inputs, chars, first, length, kept, np.ones(len(first)))
    for name, value in net.p.items():
        at = np.unravel_index(np.argmax(np.abs(grads[name])), value.shape)
        before = value[at]
        value[at] = before + 1e-4
        up = logits()
        value[at] = before - 1e-4
        down = logits()
        value[at] = before
        assert (up - down) / 2e-4 == pytest.approx(grads[name][at], rel=1e-2, abs=1e-4)


def test_windows_cover_every_word():
    kind = toxicity.word_kind()
    for n in (1, 47, 48, 49, 80, 81, 500):
        raw = b"w " * n
        inputs = toxicity.Inputs(kind, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        first, length, _ = inputs.windows()
        covered = {i for a, b in zip(first, length) for i in range(a, a + b)}
        assert covered == set(range(n)) and length.max() <= toxicity.WINDOW


def test_class_prior():
    rng = np.random.default_rng(0)
    positive = rng.normal(1.5, 1, (3000, 5))
    unlabelled = np.vstack([rng.normal(1.5, 1, (2100, 5)), rng.normal(-1.5, 1, (900, 5))])
    assert abs(quality.class_prior(positive, unlabelled) - 0.7) < 0.06


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (7, None), (None, 1)], "doc_id long, y int")
    always = F.lit(True)
    for docs in (odd, none):
        q = quality.scored(docs, quality.fitted(docs, labels, always, label="y"), score="_q")
        t = toxicity.scored(docs, toxicity.fitted(docs, labels, always, label="y"), score="_t")
        for df, name in ((q, "_q"), (t, "_t")):
            assert df.columns == [*docs.columns, name] and df.count() == docs.count()
            assert df.where(F.col(name).isNull() | ~F.col(name).between(0, 1)).count() == 0
    assert toxicity.fitted(odd, labels.limit(0), always, label="y") is None
    assert quality.fitted(odd, labels.limit(0), always, label="y") is None
    assert quality.scored(odd, None, score="_q").where("_q = 0.5").count() == odd.count()


def test_language_odd_rows(spark, odd, none):
    train = spark.createDataFrame(
        [(1, "the thing of that", "en"), (2, "der die und das", "de"), (3, None, "de"), (4, "lost", None)], "doc_id long, text string, lang string"
    )
    found = {(r.doc_id, r.text and r.text[:5]): r for r in langid.identified(odd, langid.fitted(train)).collect()}
    assert {found[1, None].lang_pred, found[2, ""].lang_pred, found[3, "   \n\t"[:5]].lang_pred} == {"und"}
    assert found[4, "a"].lang_pred in ("en", "de")
    assert langid.identified(none, langid.fitted(train)).count() == 0
    assert {r.lang_pred for r in langid.identified(odd, langid.fitted(train.limit(0))).collect()} == {"und"}


def test_filter_finds_all_languages():
    keys = np.arange(1000, dtype=np.uint64) * np.uint64(77)
    masks = np.zeros((2, 1 << 14), np.uint64)
    for i, own in ((0, keys[:600]), (70, keys[400:])):
        for place in langid.slots(own, 14):
            np.bitwise_or.at(masks[i // 64], place, np.uint64(1) << np.uint64(i % 64))
    model = langid.Filter([str(i) for i in range(71)], masks, 14)
    shares = model.shares(keys[:500], np.array([0, 500]))
    assert shares[0, 0] == 1 and abs(shares[0, 70] - 0.2) < 0.05


def test_language_filter_grows_with_its_trigrams(spark, monkeypatch):
    """One language has more distinct trigrams than a slice has slots; two have few."""
    monkeypatch.setattr(langid, "LEAST_BITS", 12)
    monkeypatch.setattr(langid, "MOST_BITS", 12)
    rng = np.random.default_rng(5)
    kinds = {"zh": (0x4E00, 40), "ja": (0x5600, 2), "ko": (0xAC00, 2)}
    own = {k: ["".join(map(chr, rng.integers(first, first + 2000, 300))) for _ in range(n)] for k, (first, n) in kinds.items()}
    rows = [(k, t) for k, texts in own.items() for t in texts]
    model = langid.fitted(spark.createDataFrame(rows, "lang string, text string"))
    asked = [(k, t[i : i + 40]) for k, texts in own.items() for t in texts[:10] for i in range(0, 260, 20)]
    asked += [(langid.UNDETERMINED, None), (langid.UNDETERMINED, "1 2")]
    found = langid.identified(spark.createDataFrame(asked, "_hits string, text string"), model)
    assert found.columns == ["_hits", "text", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == len(asked) and [r for r in got if r.lang_pred != r["_hits"]] == []
    # A slice holds no more slots than it may, and no language is found everywhere.
    some = model.slice(0)
    assert some.masks.shape[1] <= 1 << 12 and some.wrong.max() < 0.08


def test_languages_equal_exact_sets(spark):
    """The same decision from plain sets of trigrams instead of filters, over whole held-out texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    everything = [tuple(r) for r in docs.collect()] + [(-1, None, "en"), (-2, "", None), (-3, "42 !?", "de"), (-4, "É", None)]
    rows = spark.createDataFrame(everything, "doc_id long, text string, lang string")

    def grams(text):
        low = f" {(text or '').lower()} "
        plain = "".join(c if c.isalpha() else " " for c in low)
        return [plain[i - 1 : i + 2] for i in range(1, len(plain) - 1) if plain[i] != " "]

    train = [r for r in everything if zlib.crc32(str(r[0]).encode()) % 5 and r[2] is not None and r[1] is not None]
    counts, texts = {}, Counter()
    for _, text, lang in train:
        counts.setdefault(lang, Counter()).update(grams(text))
        texts[lang] += 1
    languages = sorted(counts, key=lambda x: (-texts[x], x))
    total = {x: sum(counts[x].values()) for x in languages}
    top = {g: max(counts[x][g] / total[x] for x in languages) for c in counts.values() for g in c}
    sets = {x: {g for g, n in counts[x].items() if n / total[x] * 4 >= top[g]} for x in languages}
    training = rows.where(~queries.held_out(F.col("doc_id")))
    found = {r.doc_id: r for r in langid.identified(rows, langid.fitted(training)).collect()}
    assert len(found) == len(everything) and len(languages) > 2
    for key, text, _ in everything:
        own = grams(text)
        shares = [sum(g in sets[x] for g in own) / max(len(own), 1) for x in languages]
        best = int(np.argmax(shares))
        row = found[key]
        if not own:
            assert (row.lang_pred, row.score) == ("und", 0)
        elif shares[best] - sorted(shares)[-2] > 0.05:
            assert row.lang_pred == languages[best] and abs(row.score - shares[best] / sum(shares)) < 0.05, (key, shares, row.score)
    clear = [k for k, t, _ in everything if len(grams(t)) > 50]
    assert np.mean([found[k].lang_pred == languages[int(np.argmax([sum(g in sets[x] for g in grams(t)) for x in languages]))] for k, t, _ in everything if k in set(clear)]) == 1
