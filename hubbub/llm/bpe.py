"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A token sequence is the BPE encoding of its bytes exactly if each token encodes to itself and each
neighbouring pair encodes to that pair. So a text has one path through the nondeterministic machine
whose states are (last token, place in the vocabulary's trie). ``Transducer`` follows all paths at
once: a determinised state holds the tokens that each open path has not yet agreed on. A path
lives as long as some token may still end ahead of it. Tokens are emitted once all open paths share them,
which is after at most the longest token's bytes. States and
their transitions are made when first met and forgotten together at ``max_states``, so memory is
bounded; frequent pieces are kept in a bounded table.

Null texts count as empty: no tokens. Each match of the split pattern is encoded separately, without
special tokens. The vocabulary's size is fixed (one file), so it is broadcast.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from hubbub.llm.common import added

#: White space of the split pattern (the Unicode property White_Space); fixed values.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


#: Letters and numbers of Unicode 16 that the standard library may not know yet; fixed values.
NEWER = {
    "L": "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B "
    "1138E 11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0",
    "N": "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA",
}


def _class_of(letter: str) -> str:
    """Ranges of all characters whose general category begins with ``letter``."""
    out, start = [], None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == letter
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append((start, c - 1))
            start = None
    out += [(int(r[0], 16), int(r[-1], 16)) for r in (x.split("-") for x in NEWER[letter].split())]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def compiled(pattern: str) -> re.Pattern:
    """A split pattern with ``\\p{L}``, ``\\p{N}`` and ``\\s`` for the standard library's ``re``."""
    classes = {"\\p{L}": _class_of("L"), "\\p{N}": _class_of("N"), "\\s": WHITE}

    def inside(found: re.Match) -> str:
        out = found[0]
        for name, ranges in classes.items():
            out = out.replace(name, ranges)
        return out

    parts = re.split(r"(\[[^\]]*\])", pattern)
    for i in range(0, len(parts), 2):
        for name, ranges in classes.items():
            parts[i] = parts[i].replace(name, f"[{ranges}]")
        parts[i] = parts[i].replace("\\S", f"[^{WHITE}]")
    for i in range(1, len(parts), 2):
        parts[i] = inside(re.match(r"(?s).*", parts[i]))
    return re.compile("".join(parts))


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class Transducer:
    """Encodes pieces of bytes; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 500_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}  # node << 8 | byte -> node; the root is node 0
        self.token: list[int] = [-1]  # the token that ends in each node
        self.inner: list[bool] = [True]
        halves: dict[bytes, list[bytes]] = {}
        for raw, rank in ranks.items():
            if len(raw) > 1:
                halves[raw] = self.merged(raw, 2)
                if len(halves[raw]) > 2:
                    continue  # no merge makes it: it stands only for a whole piece
            node = 0
            for b in raw:
                self.inner[node] = True
                key = node << 8 | b
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = rank
        #: The tokens that a token was merged from, or -1, and the token that two make side by side.
        self.left, self.right = [-1] * (max(ranks.values()) + 1), [-1] * (max(ranks.values()) + 1)
        for raw, h in halves.items():
            if len(h) == 2:
                self.left[ranks[raw]], self.right[ranks[raw]] = ranks[h[0]], ranks[h[1]]
        self.joined: dict[int, int] = {}
        for raw, rank in ranks.items():
            for i in range(1, len(raw)):
                first, second = ranks.get(raw[:i]), ranks.get(raw[i:])
                if first is not None and second is not None:
                    self.joined[first << 32 | second] = rank
        #: Whether every token comes after its halves, as in any trained vocabulary.
        self.ordered = all(max(x, y) < t for t, (x, y) in enumerate(zip(self.left, self.right)) if x >= 0)
        self._forget()

    def _forget(self) -> None:
        # A state: (last emitted token, ((tokens of an open path, its node), ...)).
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # state << 8 | byte
        self.pairs: dict[int, bool] = {}
        self.start = self._state((-1, (((), 0),)))

    def _state(self, state: tuple) -> int:
        known = self.ids.get(state)
        if known is None:
            known = self.ids[state] = len(self.states)
            self.states.append(state)
        return known

    def merged(self, raw: bytes, least: int = 1) -> list[bytes]:
        """The plain definition: merge the neighbours of lowest rank, leftmost first."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > least:
            best = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding.

        Both tokens are taken apart again, the later merge first. They cannot stand together if, at
        some point, the two parts at the border would have merged before the merge just undone.
        """
        if not self.ordered:
            a, b = self.bytes_of[left], self.bytes_of[right]
            return self.merged(a + b) == [a, b]
        a, b, first, second, joined = left, right, self.left, self.right, self.joined
        until_a = until_b = 1 << 60  # rank of the merge that takes each part away from the border
        while True:
            rank = joined.get(a << 32 | b)
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if first[b] >= 0 and (b >= a or second[a] < 0):
                until_b, b = b, first[b]
            elif second[a] >= 0:
                until_a, a = a, second[a]
            else:
                return True

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, paths = self.states[state]
        child, ends, inner, pairs = self.child, self.token, self.inner, self.pairs
        out = []
        for tokens, node in paths:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if inner[node]:
                out.append((tokens, node))
            token = ends[node]
            if token >= 0:
                before = tokens[-1] if tokens else last
                pair = before << 32 | token
                fits = before < 0 or pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.follows(before, token)
                if fits:
                    out.append(((*tokens, token), 0))
        if len(out) == 1:  # the usual case: one path, which emits all it has
            emitted, node = out[0]
            if emitted:
                last, out = emitted[-1], [((), node)]
        else:
            emitted = out[0][0]
            for tokens, _ in out:
                while emitted != tokens[: len(emitted)]:
                    emitted = emitted[:-1]
            if emitted:
                n, last = len(emitted), emitted[-1]
                out = [(tokens[n:], node) for tokens, node in out]
            if all(tokens for tokens, _ in out):
                last = -2  # no path can meet it any more
        known = self.moves[state << 8 | byte] = self._state((last, tuple(out))), emitted
        return known

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.max_states:
            self._forget()
        state, out, moves = self.start, [], self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte) or self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        for tokens, node in self.states[state][1]:
            if node == 0:
                return (*out, *tokens)
        return tuple(out)


class Encoder(dict):
    """Token ids of texts. The mapping holds the ids of up to ``max_pieces`` known pieces."""

    def __init__(
        self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 500_000, max_states: int = 500_000
    ):
        super().__init__()
        self.machine, self.split = Transducer(ranks, max_states), compiled(pattern)
        self.max_pieces = max_pieces

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.machine.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= self.max_pieces:
                self.clear()
            self[piece] = ids
        return ids

    def blocks(self, text: str, pieces: int = 1 << 16) -> Iterator[list[int]]:
        """The ids of a text, some tens of thousands of pieces at a time."""
        if len(text) <= 1 << 20:
            yield list(chain.from_iterable(map(self.__getitem__, self.split.findall(text))))
            return
        found = self.split.finditer(text)
        while part := [m[0] for m in islice(found, pieces)]:
            yield list(chain.from_iterable(map(self.__getitem__, part)))


class Decoder:
    """Token ids back to text as they arrive: bytes of an unfinished character wait for the rest."""

    def __init__(self, ranks: dict[bytes, int]):
        self.raw = {i: b for b, i in ranks.items()}
        self.shown = {i: str(i) for i in self.raw}
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(self.bytes(ids))

    def end(self) -> str:
        """What an unfinished character leaves, as a replacement character; then ready anew."""
        rest = self.machine.decode(b"", True)
        self.machine.reset()
        return rest


class Vocabulary:
    """The rank file and split pattern; a worker builds its tools once and keeps them over tasks."""

    def __init__(self, path: str, pattern: str, most_kept: int):
        self.raw, self.pattern, self.most_kept = Path(path).read_bytes(), pattern, most_kept
        self.made = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None}

    def tools(self) -> tuple[Encoder, Decoder]:
        if self.made is None:
            gc.disable()  # the tables are large and hold no cycles; scanning them takes most of the time
            ranks = read_ranks(self.raw)
            self.made = Encoder(ranks, self.pattern, self.most_kept, self.most_kept), Decoder(ranks)
        return self.made

    def release(self) -> None:
        """Give the tools' memory back; the next task builds them anew."""
        self.made = None
        gc.enable()
        gc.collect()


#: Pieces, and states, that a worker keeps: about 1 kB for both together.
MOST_KEPT = 500_000


def _tools(docs: DataFrame, path: str, pattern: str, most_kept: int = MOST_KEPT):
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(path, pattern, most_kept))

    def tools() -> tuple[Encoder, Decoder]:
        return sent.value.tools()

    tools.release = lambda: sent.value.release()
    return tools


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns with the token ids of ``text`` in ``ids``."""
    tools = _tools(docs, path, pattern)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder, _ = tools()
        column = batch.column(batch.schema.get_field_index(text))
        return [
            pa.array([list(chain.from_iterable(encoder.blocks(t.as_py() or ""))) for t in column], pa.list_(pa.int32()))
        ]

    return added(docs, step, [StructField(ids, ArrayType(IntegerType()))])


def decoded(rows: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns with the text of ``ids`` in ``text``; null ids give an empty text."""
    tools = _tools(rows, path, pattern)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        _, decoder = tools()
        column = batch.column(batch.schema.get_field_index(ids))
        return [pa.array([decoder.feed(x.as_py() or ()) + decoder.end() for x in column], pa.string())]

    return added(rows, step, [StructField(text, StringType())])


def encoded_checked(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    intact: str = "intact",
    most_kept: int = MOST_KEPT,
) -> DataFrame:
    """As ``encoded``, with ``intact``: whether the ids decode to the text's bytes.

    For use among other stages: workers outlive a stage, so each task gives its tools back.
    """
    tools = _tools(docs, path, pattern, most_kept)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder, decoder = tools()
        found, same = [], []
        for value in batch.column(batch.schema.get_field_index(text)):
            value = value.as_py() or ""
            found.append(list(chain.from_iterable(encoder.blocks(value))))
            same.append(decoder.feed(found[-1]) + decoder.end() == value)
        return [pa.array(found, pa.list_(pa.int32())), pa.array(same, pa.bool_())]

    fields = [StructField(ids, ArrayType(IntegerType())), StructField(intact, BooleanType())]
    return added(docs, step, fields, tools.release)


#: Columns of ``round_trip``.
DIGESTS = [
    StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
]


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns with the number of tokens and digests of the ids and of their decoded bytes.

    Each text is encoded and decoded in one pass, block by block, so that ids never leave the worker.
    """
    tools = _tools(docs, path, pattern)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder, decoder = tools()
        shown = decoder.shown
        counts, ids_digests, digests = [], [], []
        for value in batch.column(batch.schema.get_field_index(text)):
            n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
            for ids in encoder.blocks(value.as_py() or ""):
                of_ids.update((("," if n else "") + ",".join(map(shown.__getitem__, ids))).encode())
                of_bytes.update(decoder.feed(ids).encode())
                n += len(ids)
            of_bytes.update(decoder.end().encode())
            counts.append(n)
            ids_digests.append(of_ids.hexdigest())
            digests.append(of_bytes.hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(digests)]

    return added(docs, step, DIGESTS)
