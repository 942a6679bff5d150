import hashlib
import random
import re
import zlib

import pytest

from hubbub.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, part string, block string, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def best_edits(rows):
    """(cost, audit, repaired rows) of [(role, text, fault)] by the grammar as an automaton."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, said) in list(out.items()):
                for letter in "ua":
                    to = step.get((state, letter))
                    new = (cost + 3, audit + "I", (*said, (name[letter], "")))
                    if to is not None and (to not in out or new < out[to]):
                        out[to] = new
        return out

    states = {0: (0, "", ())}
    for role, text, fault in rows:
        new = {}

        def offer(state, *value):
            if state not in new or value < new[state]:
                new[state] = value

        for state, (cost, audit, said) in inserted(states).items():
            offer(state, cost + 4, audit + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            for letter in "sua":
                to = step.get((state, letter))
                if to is None:
                    continue
                if role[:1] == letter:
                    offer(to, cost + extra, audit + "K", (*said, (role, text)))
                elif letter != "s":
                    offer(to, cost + 3 + extra, audit + "R", (*said, (name[letter], text)))
        states = new
    return min(v for s, v in inserted(states).items() if s in (0, 3))


def brute(rows):
    out, groups = [], {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faulty, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for turn, role, text in found:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, said = best_edits(faulty)
        whole = "\n".join(f"{r}:{t}" for r, t in said)
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(map(repr, out))


def plain(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(repr(tuple(r)) for r in df.select(*names).collect())


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["One.", "two", " \t", "", None, "Three!", "vier? ", "five\n", "“six”"]
    roles = ["user", "assistant", "system", "tool", "", None, "users"]
    weights = [8, 8, 2, 1, 1, 1, 1]
    return [
        (conv, rng.choice([None, *range(most)]), rng.choices(roles, weights)[0], f"{rng.random():.2f}." if rng.random() < 0.5 else rng.choice(texts))
        for conv in range(conversations)
        for _ in range(rng.randrange(most))
    ]


@pytest.mark.parametrize("size", [1, 3, 128])
def test_random_conversations(spark, monkeypatch, size):
    """Blocks of any size give what the automaton gives for whole conversations."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", size)
    rows = random_rows(size, 60, 14)
    assert plain(repair.repaired(frame(spark, rows))) == brute(rows)


def test_alignment_of_a_block_from_every_phase():
    rng = random.Random(5)
    letters = {0: "", 1: "s", 2: "u", 3: "ua"}
    for _ in range(300):
        rows = [(rng.choice("uuaast"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(1, 9))]
        for phase in (0, 1, 2, 3):
            found = repair.aligned(rows, phase)
            closed = min((c + (3 * len(repair.CLOSING[p])), a + repair.CLOSING[p]) for p, (c, a) in found.items())
            # What comes before costs nothing and is kept as it is.
            before = [({"s": "system", "u": "user", "a": "assistant"}[x], f"{i}.", None) for i, x in enumerate(letters[phase])]
            name = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
            after = [(name[c], f"t{i}", {0: None, 1: "blank", 2: "truncated"}[fault]) for i, (c, fault) in enumerate(rows)]
            cost, audit, _ = best_edits(before + after)
            if audit.startswith("K" * len(before)):
                assert closed == (cost, audit[len(before) :])
            else:
                assert closed[0] >= cost


def test_a_hot_conversation_over_many_tasks(spark):
    rng = random.Random(6)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"text {rng.randrange(900)}" + rng.choice(["", ".", "!"])) for t in range(1500)]
    rows += [(7, 3, "user", "the same row.")] * 200 + [(1, 0, "user", "a."), (1, 1, "assistant", "b.")]
    assert plain(repair.repaired(frame(spark, rows).repartition(8))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (2, 0, "", "x."), (3, 0, "user", "u."), (3, 0, "user", "u."), (3, 0, "user", "other."),
        (None, 1, "user", "n."), (None, 2, "assistant", "m."), (4, -5, "system", "only a system turn."),
        (5, None, "user", "null turns."), (5, None, "assistant", "both?"), (5, 3, "user", "then three!"),
        (6, 1, "user", "word. " * 40_000), (6, 2, "assistant", "x" * 300_000), (8, 10**12, "user", "日本語。"), (8, 0, "assistant", "\U0001f600."),
    ]
    assert plain(repair.repaired(frame(spark, rows))) == brute(rows)


def test_empty_table_and_vanished_conversations(spark):
    assert repair.repaired(frame(spark, [])).collect() == []
    lost = next(c for c in range(999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repaired(repair.damaged(frame(spark, [(lost, 0, "user", "gone.")]))).collect()
    assert [tuple(r) for r in row] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(40), None) for t, r, x in ((0, "user", "A. b!"), (1, "assistant", None), (None, None, "c?"))]
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        r, x = ("user" if kind == 4 else r), ("" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        out.append((c, t, r, x, {0: 0, 3: 2}.get(kind, 1)))
    found = repair.damaged(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, out)) and len({o[-1] for o in out}) == 3
