import hashlib
import itertools
import random

from hubbub.llm import fingerprints as f


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        out.append((key, len(text), hashlib.sha256(f.edited(text, after).encode()).hexdigest()))
    return out


def test_neighbours_and_edits(docs_of):
    random.seed(4)
    rows = [(random.randrange(-500, 500), " ".join(random.choices(["aa", "bcd", "é", "efgh"], k=random.randint(0, 30)))) for _ in range(400)]
    rows = list({k: (k, t) for k, t in rows}.values())
    found = f.compared(docs_of(rows), 7).orderBy("doc_id", ascending=False).collect()
    got = [(r.doc_id, r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest()) for r in found]
    assert got == expected(rows)


def test_odd_rows(odd, none):
    rows = f.compared(odd).collect()
    assert len(rows) == odd.count()
    by_text = {}
    for r, t in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.n_chars)), range(99)):
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(x) == 1 for x in by_text.values())
    assert by_text[6, 55] == by_text[7, 55]
    assert f.compared(none).count() == 0


def test_equal_substrings_share_phrases_at_any_offset():
    random.seed(2)
    letters = "abcdefghijklmnopqrstuvwxyz "
    make = lambda n: "".join(random.choices(letters, k=n)).encode()
    shared = make(3000)
    a, b, c = f.fingerprints([make(7) + shared, make(800) + shared, make(3000)])
    assert f.likeness(a, b) > 0.5 and f.likeness(a, c) < 0.1
    alone = [f.fingerprints([t])[0].tolist() for t in (shared, b"x", b"")]
    together = [x.tolist() for x in f.fingerprints([shared, b"x", b""])]
    assert alone == together


def test_parsing_cost_falls_by_level():
    random.seed(3)
    text = "".join(random.choices("abcdefgh ", k=20_000)).encode()
    import numpy as np

    symbols, of = f.mixed(np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)), np.zeros(len(text), int)
    sizes = [len(symbols)]
    for _ in range(3):
        symbols, of, _ = f._phrases(symbols, of)
        sizes.append(len(symbols))
    assert all(b < a / 2 for a, b in zip(sizes, sizes[1:]))


def test_one_rule_for_all_lengths(docs_of):
    random.seed(6)
    words = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(random.choices(words, k=60))[:300] for _ in range(30)]
    for n in (60, 120, 158, 200, 290):
        alike = [f.likeness(*f.fingerprints([t[:n].encode(), t[: n + 4].encode()])) for t in texts]
        assert min(alike) > 0.6, n
    # The edited text, without anything to follow it, is shorter than 160 bytes.
    rows = [(2 * i + d, t[:200] if d else "") for i, t in enumerate(texts) for d in (0, 1)]
    near = [r.near_edited for r in f.compared(docs_of(rows), 3).collect() if r.n_chars]
    assert len(near) == len(texts) and min(near) > 0.45


def test_rows_without_ids_are_neighbours_by_text(docs_of):
    """After the smallest id comes the smallest text among rows without one, then the next, then the first id."""
    rows = [(5, "e" * 30), (9, "n" * 30)] + [(None, c * 30) for c in "zbmkq"]
    found = {r.edited_text for r in f.compared(docs_of(rows), partitions=3).collect()}
    order = ["n", "e", "b", "k", "m", "q", "z"]
    assert found == {a * 20 + b * 10 for a, b in zip(order, [*order[1:], "n"])}


FULL = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
    return x ^ x >> 31


def plain_sketch(text):
    """The parse of one text, symbol by symbol."""
    symbols, kept = [mix(b + 1) for b in text], set()
    for level in f.LEVELS:
        runs = [(s, len(list(same))) for s, same in itertools.groupby(symbols)]
        if level > 1:
            kept |= {s >> 32 for s, n in runs if n > 1}
        own = [s if n == 1 else mix(s + n * 0xD6E8FEB86659FD93 & FULL) for s, n in runs]
        names = own
        for _ in range(3):
            tossed = []
            for left, name in zip([None, *names], names):
                differ = 1 if left is None else left ^ name
                place = (differ & -differ).bit_length() - 1
                tossed.append((place << 1) | (name >> place & 1) if differ else 0)
            names = [n + 64 * (i > 0 and n == tossed[i - 1]) for i, n in enumerate(tossed)]
        phrases, here = [], []
        for i, s in enumerate(own):
            if 1 < i < len(own) - 1 and names[i - 1] < names[i] >= names[i + 1]:
                phrases.append(here)
                here = []
            here.append(s)
        phrases += [here] if here else []
        weight = lambda i: mix((i + 1) * 0x9E3779B97F4A7C15 & FULL) | 1
        symbols = [mix(sum(mix(s + 1 & FULL) * weight(i) for i, s in enumerate(p)) & FULL) for p in phrases]
        kept |= {(s + level & FULL) >> 32 for s in symbols}
    return sorted(kept)[: f.SKETCH]


def test_parse_equals_a_plain_one():
    random.seed(9)
    texts = [b"", b"x", b"aa", b"ab", b"aaaaaaa", b"ab" * 50, bytes(range(256)), "é漢😀 \n".encode() * 9, b"z" * 5000]
    texts += [bytes(random.choices(b"ab c"[: random.randint(2, 4)], k=random.randint(1, 300))) for _ in range(200)]
    texts += ["".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=2000)).encode()]
    for some in (texts, texts[::-1], *[[t] for t in texts[:12]]):
        assert [x.tolist() for x in f.fingerprints(some)] == [plain_sketch(t) for t in some]
