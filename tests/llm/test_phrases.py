import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hubbub.llm import phrases

NAMES = ["text", "lang", "phrase", "a", "l", "r", "n", "score", "rank", "bucket"]


def frame(spark, rows):
    schema = StructType([StructField("doc_id", LongType()), *[StructField(n, StringType()) for n in NAMES]])
    return spark.createDataFrame([(0, t, lang, *["x"] * 8) for t, lang in rows], schema)


def brute(rows, longest=3, least=10, top=2000):
    counts = Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang or "und", tuple(words[i : i + m])] += 1
    often = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    total = Counter()
    for (lang, p), a in counts.items():
        total[lang] += a if len(p) == 1 else 0
    out = {}
    for (lang, p), a in often.items():
        holds = [b for (other, q), b in often.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 50 * a for b in holds):
            continue
        cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, rank + 1, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def plain(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["The", "of", "new", "york", "city", "É", "tür", "\x00", "a'b", "日本", *[f"w{i}" for i in range(12)]]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "!?", "\r\n", ":x "]
    return [
        ("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_equals_brute_force(spark, longest):
    rows = corpus(longest)
    assert plain(phrases.collocations(frame(spark, rows), longest)) == brute(rows, longest)


def test_many_buckets_and_spread_leads(spark, monkeypatch):
    """Small chunks, many buckets, nearly every lead spread over buckets by its third word."""
    for name, value in (("BUCKET_WORDS", 50), ("CHUNK_BYTES", 2_000), ("HOT_SHARE", 1e-3), ("SALTS", 7), ("MOST_SINGLE", 20), ("SMALL", 8)):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus(9, 400) + [(f"new york u{i}", "en") for i in range(300)]
    assert plain(phrases.collocations(frame(spark, rows).repartition(6))) == brute(rows)


def test_top_and_ties(spark):
    rows = [(f"a{i} b{i}. " * 12, "en") for i in range(30)]
    found = plain(phrases.collocations(frame(spark, rows), top=7))
    assert found == brute(rows, top=7) and [r[2] for r in found] == sorted(f"a{i} b{i}" for i in range(30))[:7]


def test_odd_rows(spark):
    rows = [(t, lang) for _, t in ODD for lang in ("en", None, "")]
    expected = brute([(t, lang if lang is not None else None) for t, lang in rows if lang != ""])
    empty = [("", *r[1:]) for r in brute([(t, "en") for t, lang in rows if lang == ""])]
    assert plain(phrases.collocations(frame(spark, rows))) == sorted(expected + empty)
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [(None, None), ("", "en"), ("a b", "en")])).collect() == []


def test_quicksort_counts_every_prefix():
    rng = np.random.default_rng(1)
    n = 3000
    keys = [rng.integers(0, k, n) for k in (2, 5, 9, 9)]
    keys[3][rng.random(n) < 0.3] = -1
    weight = rng.integers(1, 4, n)
    expected = Counter()
    for i in range(n):
        for d in range(4):
            prefix = tuple(int(k[i]) for k in keys[: d + 1])
            if prefix[-1] < 0:
                break
            expected[prefix] += int(weight[i])
    for small in (4, 100_000):
        phrases.SMALL, kept = small, phrases.SMALL
        found = {tuple(int(k[at]) for k in keys[: d + 1]): a for d, at, a in phrases.quicksorted(keys, weight, 25)}
        phrases.SMALL = kept
        assert found == {p: a for p, a in expected.items() if a >= 25}
