"""Chat formatting with a loss mask on tokens.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a backslash becomes
two, and ``<|`` becomes ``\\l``, so no control string of the template can come from a text, and the
formatted string can be read back exactly. The control strings are special tokens: the encoder cuts
there first, so no token reaches over the edge of a turn's text.

A conversation is rendered in the order of (turn, role, text), encoded once with offsets, and the
sorted spans of its assistant texts are intersected with the sorted token spans by binary search. A
conversation longer than ``PART_CHARS`` is written as several parts, cut between turns, which gives
the same tokens; a task streams over its sorted rows and holds one part, whatever a conversation's size.
The order of a conversation is sequential, so its rows meet in one task.

Null roles and texts count as empty. Rows of a null conversation id form one conversation. Rows with
equal keys all count, in the order of their role and text. An empty table gives no conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Characters after which a conversation goes on in a further part.
PART_CHARS = 1 << 18
#: Characters of all parts that are encoded together.
BATCH_CHARS = 1 << 19


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "\\l")


def unescaped(text: str) -> str:
    return "\\".join(part.replace("\\l", "<|") for part in text.split("\\\\"))


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """The roles and texts of a formatted string."""
    for turn in formatted.split(TURN)[1:]:
        role, text = turn.removesuffix(END).split(TEXT)
        yield unescaped(role), unescaped(text)


def tokenizer_of(raw: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(raw)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([TURN, TEXT, END])
    return tokenizer


class SharedTokenizer:
    """A tokenizer file; a worker builds the tokenizer once and keeps it over tasks."""

    def __init__(self, path: str):
        self.raw, self.made = Path(path).read_text(), None

    def __getstate__(self) -> dict:
        return {"raw": self.raw, "made": None}

    def get(self) -> Tokenizer:
        if self.made is None:
            self.made = tokenizer_of(self.raw)
        return self.made


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token that shares a character with a span; both lists are sorted."""
    edges = np.zeros(len(starts) + 1, np.int64)
    if spans:
        a, b = np.array(spans, np.int64).T
        some = b > a
        first = np.searchsorted(ends, a[some], side="right")
        last = np.searchsorted(starts, b[some], side="left")
        np.add.at(edges, first, 1)
        np.add.at(edges, last, -1)
    return (np.cumsum(edges[:-1]) > 0).astype(np.int8)


PARTS = "conv_id {kind}, part int, formatted string, ids array<int>, loss array<byte>"


def formatted(rows: DataFrame, tokenizer_file: str, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation and part: the string, its token ids and their loss mask.

    Parts of one conversation follow each other in one partition.
    """
    raw = rows.sparkSession.sparkContext.broadcast(SharedTokenizer(tokenizer_file))
    kind = dict(rows.dtypes)["conv_id"]
    sorted_rows = (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, int, str, list[tuple[int, int]]]]:
        key, part, pieces, spans, at = None, -1, [], [], 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                new = part < 0 or conv != key
                if (new or at >= PART_CHARS) and pieces:
                    yield key, part, "".join(pieces), spans
                    pieces, spans, at = [], [], 0
                    part += 1
                if new:
                    key, part = conv, 0
                head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
                if role == loss_role:
                    spans.append((at + len(head), at + len(head) + len(body)))
                pieces += [head, body, END]
                at += len(head) + len(body) + len(END)
        if pieces:
            yield key, part, "".join(pieces), spans

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = raw.value.get()
        ready: list = []

        def flushed() -> pa.RecordBatch:
            encodings = tokenizer.encode_batch([r[2] for r in ready], add_special_tokens=False)
            masks = []
            for (_, _, _, spans), e in zip(ready, encodings):
                offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
                masks.append(token_mask(offsets[:, 0], offsets[:, 1], spans))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in ready], kinds),
                    pa.array([r[1] for r in ready], pa.int32()),
                    pa.array([r[2] for r in ready], pa.string()),
                    pa.array([e.ids for e in encodings], pa.list_(pa.int32())),
                    pa.array(masks, pa.list_(pa.int8())),
                ],
                names=["conv_id", "part", "formatted", "ids", "loss"],
            )

        kinds, size = None, 0

        def typed(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kinds
            for batch in source:
                kinds = batch.schema.field(0).type
                yield batch

        for row in parts(typed(batches)):
            ready.append(row)
            size += len(row[2])
            if size >= BATCH_CHARS or len(ready) >= 2000:
                yield flushed()
                ready, size = [], 0
        if ready:
            yield flushed()

    return sorted_rows.mapInArrow(run, PARTS.format(kind=kind))


DIGESTS = (
    "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(written: DataFrame, tokenizer_file: str) -> DataFrame:
    """Digests per conversation, from the formatted strings and from the tokens under the mask.

    ``written`` is the output of ``formatted``, with its parts still in their order.
    """
    raw = written.sparkSession.sparkContext.broadcast(SharedTokenizer(tokenizer_file))
    kind = dict(written.dtypes)["conv_id"]
    schema = DIGESTS.format(kind=kind)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = raw.value.get()
        done, kinds, state = [], None, None

        def closed() -> tuple:
            key, n, turns, n_loss, loss, chars = state
            return key, n, turns.hexdigest(), n_loss, loss.hexdigest(), chars

        def table() -> pa.RecordBatch:
            types = [kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        for batch in batches:
            kinds = batch.schema.field(0).type
            for conv, part, text, ids, mask in zip(*(batch.column(i) for i in range(5))):
                conv = conv.as_py()
                if part.as_py() == 0:
                    if state:
                        done.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = text.as_py()
                for role, said in turns_of(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                state[5] += len(text)
                marks = np.concatenate([[0], mask.values.to_numpy(), [0]])
                ids = ids.values.to_numpy()
                edges = np.diff(marks)
                runs = [ids[a:b] for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]
                for said in tokenizer.decode_batch(runs, skip_special_tokens=False):
                    said = unescaped(said)
                    state[3] += len(said)
                    state[4].update(said.encode())
            if len(done) >= 5000:
                yield table()
                done = []
        if state:
            done.append(closed())
            yield table()

    return written.mapInArrow(run, schema)
