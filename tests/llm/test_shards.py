import random
import zlib
from collections import Counter

from hubbub.llm import shards


def brute_packed(sizes, capacity):
    room, out = [], []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(room)
            room.append(max(capacity, size))
        room[i] -= size
        out.append(i)
    return out


def test_tree_gives_best_fit_decreasing():
    random.seed(1)
    for _ in range(60):
        sizes = sorted((random.randint(1, 50) for _ in range(random.randint(0, 80))), reverse=True)
        assert shards.packed(sizes, 60) == brute_packed(sizes, 60)


def checked(rows, found, n):
    assert len(found) == len(rows)
    size = {}
    for r in found:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
    for s in size:
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows
    )
    return size


def test_near_equal_and_groups_whole(docs_of):
    random.seed(2)
    rows = [(i, "x" * random.randint(0, 300) + str(i % 900)) for i in range(2000)]
    found = shards.sharded(docs_of(rows), 16).collect()
    size = checked(rows, found, 16)
    assert len(size) == 16 and max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 16
    text = dict(rows)
    by_text = {}
    for r in found:
        by_text.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(x) == 1 for x in by_text.values())


def test_group_larger_than_a_shard(docs_of):
    rows = [(i, "copy of a hot text") for i in range(700)] + [(1000 + i, f"other {i} " * 3) for i in range(600)]
    found = shards.sharded(docs_of(rows), 8).collect()
    size = checked(rows, found, 8)
    assert len(size) == 8 and max(size.values()) - min(size.values()) < 0.02 * sum(size.values())
    hot = Counter(r.shard for r in found if r.doc_id < 1000)
    share = -(-sum(size.values()) // 8)
    assert len(hot) == -(-700 // (share // 19))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    checked(rows, shards.sharded(odd, 4).collect(), 4)
    assert shards.sharded(none, 4).count() == 0
