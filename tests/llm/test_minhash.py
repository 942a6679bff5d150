import random

import numpy as np
import pytest
from conftest_tools import words_of
from pyspark.sql import functions as F

from hubbub.llm import minhash
from hubbub.llm.components import components


def brute(rows, percent=75):
    sets = []
    for _, text in rows:
        w = words_of(text, r"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [k for k in least[find(i)] if k is not None]
        component = min(ids) if ids and sets[i] else key
        out.append((key, len(sets[i]), component, key is not None and key == component))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near_copies(n, size=60, edits=(0, 8), seed=1):
    random.seed(seed)
    base = [f"w{random.randrange(500)}" for _ in range(size)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(random.randint(*edits)):
            own[random.randrange(size)] = f"n{random.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(minhash.clustered(odd)) == brute(rows)
    assert got(minhash.clustered(none)) == []


@pytest.mark.parametrize("block", [512, 16])
def test_near_copies_against_brute_force(docs_of, block):
    rows = near_copies(150) + [(1000 + i, t) for i, t in near_copies(40, edits=(0, 2), seed=2)]
    rows += [(2000 + i, rows[i][1]) for i in range(30)]
    assert got(minhash.clustered(docs_of(rows), block=block)) == brute(rows)


def test_sketches_fill_and_concentrate():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(1, 2**63, 700).astype(np.uint64))
    a, b, tiny = pool[:600], pool[100:], pool[:1]
    s = minhash.sketches([a, b, tiny], 360)
    assert (s != minhash.EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 500 / 700) < 0.12


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    star = spark.range(1, 2000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert components(star).where("component = 0").count() == 2000
