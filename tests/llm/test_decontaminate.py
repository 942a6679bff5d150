import hashlib

from conftest_tools import words_of

from hubbub.llm import decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words_of(text, WORD)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for key, text in rows:
        w = words_of(text, WORD)
        hit, found = set(), set()
        for length in {len(x) for x in windows}:
            for i in range(len(w) - length + 1):
                own = windows.get(tuple(w[i : i + length]))
                if own:
                    hit.update(range(i, i + length))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Ünï 日本語"), (3, None), (4, "..."), (10, "word")]


def test_against_brute_force(spark, odd, none):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, decontaminate.report(odd, bench).collect()), key=repr) == brute(rows, ITEMS)
    assert decontaminate.report(none, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(odd, empty).where("contaminated").count() == 0


def test_several_slices(spark, docs_of):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(40)]
    rows = [(i, f"pre {items[i][1]} post {items[(i * 7) % 40][1]}") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.contaminated(docs_of(rows), bench, slice_words=60)
    assert [len(r.hit_items) for r in marked.orderBy("doc_id").collect()] == [len({i, (i * 7) % 40}) for i in range(40)]


def test_spans_are_removed(spark, docs_of):
    passage = ITEMS[0][1]
    rows = [(1, "keep this, " + "filler text here " * 5 + passage.upper() + "! and é that"), (2, passage), (3, "clean"), (4, None)]
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    docs = docs_of(rows)
    out = decontaminate.cleaned(decontaminate.contaminated(docs, bench, prefix="_"), prefix="_")
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "keep this, " + "filler text here " * 5 + "! and é that",
        3: "clean",
        4: None,
    }


def test_items_without_an_id(spark, docs_of):
    """Their hits count, and they count as one item that has no name to list."""

    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = spark.createDataFrame([(None, words), (None, "one two"), (3, "one two")], "item_id long, text string")
    found = decontaminate.report(docs_of([(1, f"x {words} y"), (2, "one two three"), (3, "clean")]), items).collect()
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert rows == {1: (12, 10, 1, digest("")), 2: (3, 2, 2, digest("3")), 3: (1, 0, 0, digest(""))}


def test_removal_in_one_step_equals_two_steps(spark, odd, none):
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven"), (None, "a row")], "item_id long, text string")
    for docs in (odd, none):
        for share in (0.5, 1.0, 2.0):
            two = decontaminate.cleaned(decontaminate.contaminated(docs, items, prefix="_"), share, prefix="_")
            one = decontaminate.removed(docs, items, share)
            assert one.columns == two.columns == docs.columns
            assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
