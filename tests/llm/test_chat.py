import hashlib

import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st

from hubbub.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = st.lists(st.sampled_from(["\\", "<|", "|>", "<", "|", "l", chat.TURN, chat.END, "é", " ", "\n"]), max_size=12).map("".join)


@given(PIECES, PIECES)
def test_reversible(role, text):
    written = f"{chat.TURN}{chat.escaped(role)}{chat.TEXT}{chat.escaped(text)}{chat.END}"
    assert list(chat.turns_of(written * 2)) == [(role, text)] * 2


def expected(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_read_back(spark, monkeypatch):
    rows = [
        (1, 0, "user", "Hi <|end|> there\\"),
        (1, 1, "assistant", " leading space, 日本 \U0001f600<|turn|>assistant<|text|>no<|end|>"),
        (1, 1, "assistant", "tie"),
        (1, 2, "assistant", ""),
        (2, 0, None, None),
        (2, None, "assistant", "first"),
        (None, 0, "assistant", "no id"),
        (3, 0, "assistant", "<|endoftext|>"),
        *[(4, i, "assistant" if i % 2 else "user", f"turn {i} " * 40) for i in range(300)],
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    monkeypatch.setattr(chat, "PART_CHARS", 5_000)
    parts = chat.formatted(table, PATH)
    assert parts.where("conv_id = 4").count() > 5
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(parts, PATH).collect()}
    assert got == expected(rows)
    assert chat.read_back(chat.formatted(table.limit(0), PATH), PATH).count() == 0
