import math
import random

import pytest
from pyspark.sql import functions as F

from hubbub.llm import topk

SCHEMA = "vec_id long, embedding array<float>, place string, length string, score string, whole string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in rows], SCHEMA)


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, asks, k):
    """Rows by query row: the best (score, id) of all other rows."""
    whole = [
        (i, [math.floor(256 * f32(x)) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, (query_id, a) in enumerate(whole):
        if query_id is None or not asks(query_id):
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0, i) for c, (i, b) in enumerate(whole) if c != q]
        out += [(query_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda t: t[:3])[:k])]
    return out


def plain(rows):
    return sorted(map(repr, [tuple(r) for r in rows]))


def same(spark, rows, k=5, block=16, step=5):
    found = topk.top_inner_products(frame(spark, rows), F.col("vec_id") % step == 0, k, block=block)
    assert plain(found.select("query_id", "rank", "vec_id", "score").collect()) == plain(brute(rows, lambda i: i % step == 0, k))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vectors_over_several_blocks(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([0.1, 1, 3]) for _ in range(12)]) for i in range(150)]
    same(spark, rows)


def test_ties_copies_and_lengths(spark):
    """A hot vector, many equal scores, negative ids, vectors of several lengths."""
    rng = random.Random(3)
    rows = [(i - 20, [1.0, 1.0, 0.5]) for i in range(60)] + [(100 + i, [float(rng.randrange(-2, 3)) for _ in range(rng.randrange(5))]) for i in range(60)]
    same(spark, rows, block=16)


def test_odd_rows(spark):
    rows = [
        (0, None), (5, [1.0, None]), (10, [float("nan")]), (15, [float("inf"), 1.0]), (20, []), (25, [1.5, -2.0]),
        (25, [0.5, 1.0]), (25, [0.5, 1.0]), (None, [9.0, 9.0]), (None, None), (7, [-0.001, 0.001]), (30, [1e6, -1e6]),
    ]
    same(spark, rows, block=4)
    same(spark, rows, k=20, block=2)


def test_fewer_candidates_than_asked_for(spark):
    same(spark, [(0, [1.0]), (1, [2.0])])
    same(spark, [(0, [1.0])])
    same(spark, [(1, [1.0])])
    same(spark, [])


def test_unlike_vectors_are_pruned(spark):
    """Where few vectors are long, blocks of short ones are never reached."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * (100 if i % 40 < 8 else 0.01) for _ in range(8)]) for i in range(400)]
    same(spark, rows, block=16, step=40)


def test_whole_numbers_beyond_doubles(spark):
    rows = [(0, [3.0e6, 1.0]), (1, [3.0e6, 2.0]), (2, [3.0e6, 1.0]), (3, [-3.0e6, 9.0]), (5, [2.9999998e6, 4.0])]
    same(spark, rows, k=3, block=2)
