"""Quality classification from positive and unlabelled texts.

Trusted positives and plain web text train a small network by the non-negative unbiased risk: the risk
of positives weighted by the class prior, plus the risk of unlabelled text as negatives less the part
that positives in it explain, which is never let below zero. The prior is estimated from a positive
against unlabelled classifier: the share of unlabelled texts above a score threshold, over the share of
held-back positives above it, at the threshold where that bound is tightest.

Features are counts over the whole text: bytes, words, repeated and distinct words, repeated lines.
The fit uses at most ``most_positive`` and ``most_unlabelled`` texts, chosen by a hash of their key;
scoring covers every text.

Null and empty texts have all counts zero and are scored like any other text. Without any positive the
score is the same for all texts, 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField

from hubbub.llm.common import Words, added, ascii_lowered, byte_set, mixed, steps, text_bytes

MOST_POSITIVE, MOST_UNLABELLED = 8_000, 16_000
N_FEATURES = 256 + 8


def _runs(names: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many names equal the one before them, and how many distinct names there are."""
    n = len(before) - 1
    of = np.repeat(np.arange(n), np.diff(before))
    if not len(names):
        return np.zeros(n), np.zeros(n)
    same = np.zeros(len(names), np.int64)
    same[1:] = (names[1:] == names[:-1]) & (of[1:] == of[:-1])
    keys = np.unique(mixed(names + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    return np.bincount(of, same, n), np.bincount(of[keys], minlength=n).astype(float)


def features(column: pa.Array, words: Words, lines: Words) -> np.ndarray:
    """One row of N_FEATURES numbers per text."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), N_FEATURES), np.float32)
    for i, j in steps(offsets):
        own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        size = np.diff(at)
        of = np.repeat(np.arange(j - i), size)
        counts = np.bincount(of * 256 + own, minlength=(j - i) * 256).reshape(j - i, 256)
        rest = []
        for kind in (words, lines):
            starts, ends, before = kind.bounds(own, at)
            n = np.diff(before)
            same, distinct = _runs(kind.names(own, starts, ends), before)
            rest += [np.log1p(n), same / np.maximum(n, 1), distinct / np.maximum(n, 1)]
        shares = np.log1p(1000 * counts / np.maximum(size, 1)[:, None])
        upper = counts[:, 65:91].sum(1) / np.maximum(size, 1)
        other = counts[:, [*range(33, 44), *range(58, 65), *range(91, 97), *range(123, 127)]].sum(1) / np.maximum(size, 1)
        out[i:j] = np.column_stack([shares, *rest, upper, other])
    return out


def _kinds() -> tuple[Words, Words]:
    return Words(~byte_set((9, 13), (32, 32)), ascii_lowered()), Words(~byte_set((10, 10)), ascii_lowered())


def with_features(docs: DataFrame, text: str = "text", result: str = "features") -> DataFrame:
    words, lines = _kinds()

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        values = features(batch.column(batch.schema.get_field_index(text)), words, lines)
        return [pa.array(list(values), pa.list_(pa.float32()))]

    return added(docs, step, [StructField(result, ArrayType(FloatType()))])


class Network:
    """One hidden layer; inputs are standardised. ``score`` is the chance of a positive."""

    def __init__(self, inputs: np.ndarray, hidden: int, seed: int):
        random = np.random.default_rng(seed)
        self.mean, self.scale = inputs.mean(0), inputs.std(0) + 0.05
        n = inputs.shape[1]
        self.weights = [
            random.normal(0, 1 / np.sqrt(n), (n, hidden)),
            np.zeros(hidden),
            random.normal(0, 1 / np.sqrt(hidden), hidden),
            np.zeros(1),
        ]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.time = 0

    def standard(self, inputs: np.ndarray) -> np.ndarray:
        return np.clip((inputs - self.mean) / self.scale, -6, 6)

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.weights[0] + self.weights[1])
        return hidden @ self.weights[2] + self.weights[3][0], hidden

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.standard(inputs))[0], -30, 30)))

    def step(self, x: np.ndarray, hidden: np.ndarray, slope: np.ndarray, rate: float, decay: float) -> None:
        """One Adam step for the gradient ``slope`` of the risk by each logit."""
        back = np.outer(slope, self.weights[2]) * (1 - hidden**2)
        grads = [x.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]
        self.time += 1
        for i, (w, g) in enumerate(zip(self.weights, grads)):
            m, v = self.moments[i]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (
                m / (1 - 0.9**self.time) / (np.sqrt(v / (1 - 0.999**self.time)) + 1e-8) + (decay * w if w.ndim == 2 else 0)
            )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _trained(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int, epochs: int, seed: int) -> Network:
    """By non-negative risk with a prior; without one, plain positive against unlabelled."""
    net = Network(unlabelled, hidden, seed)
    p, u = net.standard(positive), net.standard(unlabelled)
    random = np.random.default_rng(seed + 1)
    size = 256
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for chunk in np.array_split(random.permutation(len(u)), max(1, len(u) // size)):
            xp, xu = p[random.integers(0, len(p), size)], u[chunk]
            x = np.vstack([xp, xu])
            z, hidden_now = net.logits(x)
            zp, zu = z[:size], z[size:]
            # Logistic losses: log(1 + exp(-z)) for positives, log(1 + exp(z)) for negatives.
            slope_pp, slope_pn, slope_un = -_sigmoid(-zp) / size, _sigmoid(zp) / size, _sigmoid(zu) / len(xu)
            if prior is None:
                slope = np.concatenate([0.5 * slope_pp, 0.5 * slope_un])
            else:
                rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
                if rest >= 0:
                    slope = np.concatenate([prior * (slope_pp - slope_pn), slope_un])
                else:  # over-fitted: undo, by stepping against the part that fell below zero
                    slope = np.concatenate([prior * slope_pn, -slope_un])
            net.step(x, hidden_now, slope, rate, 1e-3)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 0) -> float:
    """The share of positives in unlabelled text: the tightest bound over score thresholds.

    The classifier learns from one half of both sets and is read on the other half.
    """
    random = np.random.default_rng(seed)
    p, u = random.permutation(len(positive)), random.permutation(len(unlabelled))
    hp, hu = len(p) // 2, len(u) // 2
    if not hp or not hu:
        return 0.5
    net = _trained(positive[p[:hp]], unlabelled[u[:hu]], None, 16, 6, seed)
    sp, su = np.sort(net.score(positive[p[hp:]])), np.sort(net.score(unlabelled[u[hu:]]))
    cuts = np.quantile(sp, np.linspace(0, 0.9, 91))
    above_p = 1 - np.searchsorted(sp, cuts, side="left") / len(sp)
    above_u = 1 - np.searchsorted(su, cuts, side="left") / len(su)
    slack = np.sqrt(np.log(40) / 2 / len(su)) + np.sqrt(np.log(40) / 2 / len(sp))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.99))


def _sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows, never more, chosen by a hash of the key."""
    n = rows.count()
    part = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1 << 30)) < F.lit(int(min(1.0, 0.97 * most / max(n, 1)) * (1 << 30)))
    return (rows.where(part) if n > most else rows).limit(most)


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    hidden: int = 24,
    epochs: int = 12,
    seed: int = 7,
) -> Network | None:
    """The network; only labels of ``training`` rows are read, and of those only the positive ones."""
    trusted = labels.where(training & (F.col(label) == 1)).select(key).distinct()
    texts = docs.where(training & F.col(key).isNotNull()).select(key, text)

    def matrix(rows: DataFrame) -> np.ndarray:
        got = with_features(rows.select(text), text).select("features").toArrow()["features"].combine_chunks()
        if not len(got):
            return np.zeros((0, N_FEATURES))
        return got.values.to_numpy().reshape(-1, N_FEATURES).astype(float)

    chosen = F.broadcast(_sample(trusted, key, most_positive))  # bounded, so texts are not moved
    positive = matrix(texts.join(chosen, key, "left_semi").limit(2 * most_positive))
    unlabelled = matrix(_sample(texts, key, most_unlabelled))
    if not len(positive) or not len(unlabelled):
        return None
    return _trained(positive, unlabelled, class_prior(positive, unlabelled, seed), hidden, epochs, seed)


def scored(docs: DataFrame, model: Network | None, text: str = "text", score: str = "score") -> DataFrame:
    """All columns with the chance that a text is of good quality."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    words, lines = _kinds()

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        if sent.value is None:
            return [pa.array(np.full(batch.num_rows, 0.5))]
        values = features(batch.column(batch.schema.get_field_index(text)), words, lines)
        return [pa.array(sent.value.score(values))]

    return added(docs, step, [StructField(score, DoubleType())])
