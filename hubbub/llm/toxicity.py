"""Toxicity by a bidirectional gated recurrent network with attention pooling, written in numpy.

Each word enters twice: as a word (hashed, lower-cased) and as the mean of its character trigrams
(hashed), so that unseen forms of a known stem still count. All words of a text are covered by windows
of ``WINDOW`` words, each overlapping the one before by ``WINDOW - STRIDE``. A text's logit is its
highest window logit; in training, the windows of a text share the gradient by their softmax.

The fit takes at most ``most_texts`` labelled texts of at most ``most_bytes`` bytes, half of them toxic
where there are enough, and runs on the driver; scoring covers every window of every text.

Null texts and texts without words have no window and get the score of the smallest share of toxic
texts, 0. Without labels of both kinds there is no network and every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from hubbub.llm.common import Words, added, ascii_lowered, byte_set, steps, text_bytes

WINDOW, STRIDE = 48, 32
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 12
WIDTH, HIDDEN = 8, 8
MOST_TEXTS, MOST_BYTES = 3_000, 20_000
#: Text bytes that one vectorised scoring step takes together, and windows in one pass of the network.
STEP, PASS = 1 << 19, 2048


def word_kind() -> Words:
    return Words(byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)), ascii_lowered())


class Inputs:
    """Words of some texts: a row of the word table for each, and its trigrams' rows."""

    def __init__(self, kind: Words, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.before = kind.bounds(data, offsets)
        names = kind.names(data, starts, ends)
        self.word = 1 + (names >> np.uint64(40)).astype(np.int64) % (WORD_ROWS - 1)
        inside = kind.is_word[data]
        low = np.where(inside, kind.lowered[data], 32).astype(np.int64)
        padded = np.concatenate([[32], low, [32]])
        grams = (padded[:-2] * 7919 + padded[1:-1] * 104729 + padded[2:] * 1299709) >> 3
        self.gram = (grams % CHAR_ROWS)[inside]
        lengths = ends - starts
        self.first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.lengths = lengths

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and text of each window."""
        n = np.diff(self.before)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        text = np.repeat(np.arange(len(n)), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        first = self.before[text] + nth * STRIDE
        return first, np.minimum(WINDOW, self.before[text + 1] - first), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of value rows by row number."""
    return np.column_stack([np.bincount(rows, v, n) for v in values.T]).astype(np.float32)


class Network:
    """Parameters by name, and passes over windows of words."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        normal = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "word": normal(WORD_ROWS, WIDTH, scale=0.1),
            "char": normal(CHAR_ROWS, WIDTH, scale=0.3),
            "x": normal(2 * WIDTH, 6 * HIDDEN, scale=0.3),
            "x0": np.zeros(6 * HIDDEN, np.float32),
            "u0": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            "u1": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            "a": normal(2 * HIDDEN, 2 * HIDDEN, scale=0.3),
            "v": normal(2 * HIDDEN, scale=0.3),
            "o": normal(2 * HIDDEN, scale=0.3),
            "o0": np.full(1, -1, np.float32),
        }

    def chars(self, inputs: Inputs) -> np.ndarray:
        if not len(inputs.first):
            return np.zeros((0, WIDTH), np.float32)
        total = np.add.reduceat(self.p["char"][inputs.gram], inputs.first, axis=0)
        return total / inputs.lengths[:, None].astype(np.float32)

    def gates(self, inputs: Inputs, chars: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        table = self.p["word"] @ self.p["x"][:WIDTH] + self.p["x0"]
        out = chars @ self.p["x"][WIDTH:]
        out += table[inputs.word]
        return out

    def blind(self, inputs: Inputs, random: np.random.Generator, share: float) -> None:
        """In training, some words are seen by their characters alone: row 0 stands for any word."""
        inputs.word = np.where(random.random(len(inputs.word)) < share, 0, inputs.word)

    def forward(self, gates: np.ndarray, first: np.ndarray, length: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows. ``keep`` gets what ``backward`` needs."""
        p, n, size = self.p, len(first), int(length.max())
        states = np.zeros((size, n, 2 * HIDDEN), np.float32)
        h = HIDDEN
        tape: list = [None] * (2 * size)
        for d in range(2):
            state = np.zeros((n, h), np.float32)
            u = p[f"u{d}"]
            for t in range(size) if d == 0 else range(size - 1, -1, -1):
                live = t < length
                x = gates[np.where(live, first + t, first), 3 * h * d : 3 * h * (d + 1)]
                own = state @ u
                zr = _sigmoid(x[:, : 2 * h] + own[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * own[:, 2 * h :])
                after = new + z * (state - new)
                if not live.all():
                    after = np.where(live[:, None], after, state)
                if keep is not None:
                    tape[2 * t + d] = (state, z, r, new, own[:, 2 * h :], live)
                states[t, :, h * d : h * (d + 1)] = state = after
        mixed = np.tanh(states @ p["a"])
        weight = mixed @ p["v"]
        weight[np.arange(size)[:, None] >= length] = -np.inf
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        if keep is not None:
            keep += [tape, states, mixed, weight, pooled]
        return pooled @ p["o"] + p["o0"][0]

    def backward(self, inputs: Inputs, chars: np.ndarray, first: np.ndarray, length: np.ndarray, kept: list, slope: np.ndarray) -> dict:
        """Gradients of a loss with ``slope`` by each window's logit."""
        p, h = self.p, HIDDEN
        tape, states, mixed, weight, pooled = kept
        size, n = weight.shape
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["o"], g["o0"][0] = pooled.T @ slope, slope.sum()
        d_pooled = slope[:, None] * p["o"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnk,nk->tn", states, d_pooled)
        d_weight = weight * (d_weight - (weight * d_weight).sum(0))
        g["v"] = np.einsum("tnk,tn->k", mixed, d_weight)
        d_mixed = d_weight[:, :, None] * p["v"] * (1 - mixed**2)
        g["a"] = np.einsum("tnk,tnl->kl", states, d_mixed)
        d_states = d_states + d_mixed @ p["a"].T
        d_gates = np.zeros((len(inputs.word), 6 * h), np.float32)
        for d in range(2):
            back = np.zeros((n, h), np.float32)
            u = p[f"u{d}"]
            for t in range(size - 1, -1, -1) if d == 0 else range(size):
                state, z, r, new, own_n, live = tape[2 * t + d]
                total = back + d_states[t, :, h * d : h * (d + 1)]
                through = np.where(live[:, None], total, 0)
                d_new = through * (1 - z) * (1 - new**2)
                d_z = through * (state - new) * z * (1 - z)
                d_r = d_new * own_n * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], axis=1)
                d_own = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"u{d}"] += state.T @ d_own
                back = d_own @ u.T + through * z + np.where(live[:, None], 0, total)
                at = live.nonzero()[0]
                d_gates[first[at] + t, 3 * h * d : 3 * h * (d + 1)] += d_x[at]  # windows start apart
        g["x0"] = d_gates.sum(0)
        vectors = np.concatenate([p["word"][inputs.word], chars], axis=1)
        g["x"] = vectors.T @ d_gates
        d_vectors = d_gates @ p["x"].T
        g["word"] = _summed(inputs.word, d_vectors[:, :WIDTH], WORD_ROWS)
        per_gram = np.repeat(d_vectors[:, WIDTH:] / inputs.lengths[:, None].astype(np.float32), inputs.lengths, axis=0)
        g["char"] = _summed(inputs.gram, per_gram, CHAR_ROWS)
        return g

    def text_logits(self, inputs: Inputs) -> np.ndarray:
        """The highest window logit of each text; minus infinity without words."""
        out = np.full(len(inputs.before) - 1, -np.inf)
        first, length, text = inputs.windows()
        if not len(first):
            return out
        gates = self.gates(inputs, self.chars(inputs))
        order = np.argsort(length, kind="stable")
        for a in range(0, len(order), PASS):
            part = order[a : a + PASS]
            np.maximum.at(out, text[part], self.forward(gates, first[part], length[part]))
        return out


def trained(texts: list[str], toxic: np.ndarray, least_steps: int = 600, seed: int = 3, batch: int = 32) -> Network:
    """A network fitted to labelled texts."""
    net, kind = Network(seed), word_kind()
    random = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    sizes = np.array([len(t) for t in texts])
    epochs = max(4, -(-least_steps * batch // len(texts)))
    step, total = 0, epochs * max(1, -(-len(texts) // batch))
    for _ in range(epochs):
        error = []
        # Texts of like size together, batches in random order.
        order = np.argsort(sizes * random.uniform(0.7, 1.3, len(sizes)))
        for part in _batches(order, batch, random):
            raw = [texts[i].encode() for i in part]
            data = np.frombuffer(b"".join(raw), np.uint8)
            inputs = Inputs(kind, data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
            first, length, text = inputs.windows()
            if not len(first):
                continue
            net.blind(inputs, random, 0.3)
            chars, kept = net.chars(inputs), []
            logits = net.forward(net.gates(inputs, chars), first, length, kept)
            top = np.full(len(part), -np.inf)
            np.maximum.at(top, text, logits)
            share = np.exp(3 * (logits - top[text]))
            share /= np.bincount(text, share, len(part))[text]
            some = np.bincount(text, minlength=len(part)) > 0
            wrong = np.where(some, _sigmoid(np.where(some, top, 0)) - toxic[part], 0) / len(part)
            error.append(np.abs(wrong).sum())
            g = net.backward(inputs, chars, first, length, kept, (wrong[text] * share).astype(np.float32))
            step += 1
            rate = 0.02 * (1 - step / (total + 1)) + 0.001
            for k, w in net.p.items():
                m, v = moments[k]
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] ** 2 - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        if error and np.mean(error) < 0.004:  # learnt; a further epoch would change little
            break
    return net


def _batches(order: np.ndarray, size: int, random: np.random.Generator) -> list[np.ndarray]:
    parts = np.array_split(order, max(1, len(order) // size))
    return [parts[i] for i in random.permutation(len(parts))]


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_texts: int = MOST_TEXTS,
    most_bytes: int = MOST_BYTES,
) -> Network | None:
    """The network; only labels of ``training`` rows are read."""
    marked = labels.where(training & F.col(label).isNotNull()).select(key, (F.col(label) == 1).alias("toxic"))
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    place = F.pmod(F.xxhash64(F.col(key), F.lit(9)), F.lit(1 << 30))
    # Half of the texts toxic if there are enough; the rest of the room goes to the others.
    n_toxic = min(counts[True], most_texts // 2)
    room = {True: n_toxic, False: most_texts - n_toxic}
    chosen = marked.where(
        F.when(F.col("toxic"), place < int(min(1, room[True] / counts[True]) * (1 << 30))).otherwise(
            place < int(min(1, room[False] / counts[False]) * (1 << 30))
        )
    )
    fit = docs.where(F.octet_length(text) <= most_bytes).select(key, text)
    chosen = F.broadcast(chosen.limit(2 * most_texts))  # so the join moves ids, not texts
    rows = fit.join(chosen, key).select(text, "toxic").limit(2 * most_texts).toArrow()
    texts = rows[text].to_pylist()
    toxic = rows["toxic"].to_numpy().astype(float)
    order = sorted(range(len(texts)), key=lambda i: texts[i])
    if len(set(toxic.tolist())) < 2:
        return None
    return trained([texts[i] for i in order], toxic[order])


def scored(docs: DataFrame, model: Network | None, text: str = "text", score: str = "toxicity") -> DataFrame:
    """All columns with the chance that a text is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = word_kind()

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        if sent.value is None:
            return [pa.array(np.zeros(batch.num_rows))]
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        out = [np.zeros(0)]
        for i, j in steps(offsets, STEP):
            inputs = Inputs(kind, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out.append(_sigmoid(sent.value.text_logits(inputs)))
        return [pa.array(np.concatenate(out))]

    return added(docs, step, [StructField(score, DoubleType())])
