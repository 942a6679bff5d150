"""Language identification with bit-sliced Bloom filters over letter trigrams.

Every slot of the filter is a bitmask of languages, so one lookup of an n-gram (the masks of its slots
and-ed) returns all languages that contain it. A text's trigrams are those around each of its letters,
lower-cased, anything that is no letter counting as a space. A language contains a trigram if its share
among the language's trigrams is at least ``1 / keep_ratio`` of the trigram's largest share. Counts are
over all training rows. Per text, the number of trigrams each language contains is corrected for the
filter's false positives, whose rate is known from the share of set bits.

The number of slots follows the number of trigrams, ``SLOTS_PER_GRAM`` each at least, so the rate of false
positives stays the same however large the corpus is. The trigrams are dealt by hash into slices of
``2**MOST_BITS`` slots at most. A slice is or-ed together in Spark, slot by slot; the driver and each worker
hold one at a time. Each slice but the last is a pass over the texts of its own, and what it finds in a
text is written beside it and added up.

Null texts and texts without a letter are ``und`` with score 0; so is everything if no row could be
learnt from. Rows whose language is null are not learnt from. Ties go to the language with most
training rows, then by name.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from hubbub.llm.common import added, arrow_map, dropped, mixed, shared_folder, stored

HASHES = 2
SLOTS_PER_GRAM = 8
#: Slots of one slice, as powers of two.
LEAST_BITS, MOST_BITS = 16, 22
SLOT_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SLICE_SEED = 0xD6E8FEB86659FD93
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigram around each letter of all texts, and how many there are before each text."""
    low = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in low], np.int64)
    points = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    is_letter = letters[points.astype(np.int64)]
    points = np.where(is_letter, points, np.uint64(32))
    at = np.flatnonzero(is_letter)
    keys = points[at - 1] | points[at] << np.uint64(21) | points[at + 1] << np.uint64(42)
    return keys, np.searchsorted(at, 1 + np.concatenate([[0], np.cumsum(sizes)]))


def slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mixed(keys * np.uint64(seed)) >> np.uint64(64 - bits)).astype(np.int64) for seed in SLOT_SEEDS]


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return (mixed(keys * np.uint64(SLICE_SEED)) % np.uint64(slices)).astype(np.int64)


def _lazy(make):
    """A value that each worker makes when first asked."""
    made: list = []

    def get():
        if not made:
            made.append(make())
        return made[0]

    return get


def groups(texts: list, limit: int = 1 << 19):
    """Ranges of texts of about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Filter:
    """Languages, masks per slot, false positive rate of each language."""

    def __init__(self, languages: list[str], masks: np.ndarray, bits: int):
        self.languages, self.masks, self.bits = languages, masks, bits
        words = [(masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(languages))]
        self.wrong = np.array([w.mean() ** HASHES for w in words])

    def hits(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Corrected number of each text's trigrams that each language contains."""
        places = slots(keys, self.bits)
        out = np.zeros((len(before) - 1, len(self.languages)))
        n = np.diff(before)[:, None]
        for w in range(len(self.masks)):
            found = self.masks[w][places[0]]
            for p in places[1:]:
                found = found & self.masks[w][p]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                total = np.concatenate([[0], np.cumsum((found >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)])
                out[:, i] = total[before[1:]] - total[before[:-1]]
        return (out - n * self.wrong) / np.maximum(1 - self.wrong, 1e-9)

    def shares(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Corrected share of each text's trigrams that each language contains."""
        return as_shares(self.hits(keys, before), before)


def as_shares(hits: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.clip(hits / np.maximum(np.diff(before), 1)[:, None], 0, 1)


class Model:
    """Languages, and the filter in slices that are made when asked for."""

    def __init__(self, languages: list[str], slices: int, make: Callable[[int], Filter]):
        self.languages, self.slices, self.slice = languages, slices, make


def fitted(training: DataFrame, keep_ratio: float = 4.0, text: str = "text", lang: str = "lang") -> Model:
    """The filter of all training rows."""
    rows = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    letters = _lazy(letter_table)

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out = []
        for name in sorted(set(names)):
            own = [t for n, t in zip(names, texts) if n == name]
            for a, b in groups(own):
                keys, n = np.unique(trigrams(own[a:b], letters())[0], return_counts=True)
                out.append((np.full(len(keys), name, object), keys.astype(np.int64), n, np.arange(len(keys)) == 0, b - a))
        if not out:
            return None
        docs = np.concatenate([np.where(first, n, 0) for _, _, _, first, n in out])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([x[0] for x in out]), pa.string()),
                pa.array(np.concatenate([x[1] for x in out])),
                pa.array(np.concatenate([x[2] for x in out]).astype(np.int64)),
                pa.array(docs.astype(np.int64)),
            ],
            names=["lang", "gram", "n", "docs"],
        )

    counts = arrow_map(rows, counted, "lang string, gram long, n long, docs long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).cache()
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()
    order = sorted(per_lang, key=lambda r: (-r.docs, r.lang))
    languages = [r.lang for r in order]
    if not languages:
        counts.unpersist()
        return Model([], 1, lambda _: Filter([], np.zeros((0, 2), np.uint64), 1))
    total = F.create_map(*[F.lit(x) for r in order for x in (r.lang, float(r.n))])
    share = F.col("n") / total[F.col("lang")]
    top = counts.groupBy("gram").agg(F.max(share).alias("top"))
    kept = counts.join(top, "gram").where(share * keep_ratio >= F.col("top"))
    n_grams = top.count()
    wanted = SLOTS_PER_GRAM * n_grams + 1
    slices = -(-wanted // (1 << MOST_BITS))
    bits = int(min(MOST_BITS, max(LEAST_BITS, np.ceil(np.log2(wanted / slices)))))
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0).to_numpy().astype(np.uint64)
        number_of = batch.column(1).to_numpy()
        places = slots(keys, bits)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.tile(slice_of(keys, slices).astype(np.int32), HASHES)),
                pa.array(np.concatenate(places)),
                pa.array(np.tile(number_of // 64, HASHES)),
                pa.array(np.tile(np.int64(1) << (number_of % 64).astype(np.int64), HASHES)),
            ],
            names=["slice", "slot", "word", "mask"],
        )

    chosen = kept.select("gram", number[F.col("lang")].cast("int").alias("number"))
    filled = arrow_map(chosen, placed, "slice int, slot long, word int, mask long")
    filled = filled.groupBy("slice", "slot", "word").agg(F.expr("bit_or(mask)").alias("mask"))

    def made(rows: DataFrame) -> Filter:
        masks = np.zeros(((len(languages) + 63) // 64, 1 << bits), np.uint64)
        got = rows.select("slot", "word", "mask").toArrow()
        masks[got["word"].to_numpy(), got["slot"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
        return Filter(languages, masks, bits)

    if slices == 1:
        whole = made(filled)
        counts.unpersist()
        return Model(languages, 1, lambda _: whole)
    path = shared_folder(training.sparkSession)
    kept_slots = stored(filled.repartition("slice"), path, "slice")
    counts.unpersist()
    return Model(languages, slices, lambda i: made(kept_slots.where(F.col("slice") == i)))


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns with ``lang_pred`` and ``score``, the chosen language's part of all shares."""
    spark, letters = docs.sparkSession, _lazy(letter_table)
    languages, slices = model.languages, model.slices
    so_far = "_hits"
    while so_far in docs.columns:
        so_far += "_"

    def pass_of(number: int, sent):
        """What the slices up to this one find in each text of a batch, with the texts' trigram bounds."""

        def found(batch: pa.RecordBatch):
            known: Filter = sent.value
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            old = None
            if number:
                old = batch.column(batch.schema.get_field_index(so_far)).flatten().to_numpy().reshape(len(texts), -1)
            for a, b in groups(texts):
                keys, before = trigrams(texts[a:b], letters())
                own_keys, own_before = keys, before
                if slices > 1:
                    mine = slice_of(keys, slices) == number
                    own_keys, own_before = keys[mine], np.concatenate([[0], np.cumsum(mine)])[before]
                hits = known.hits(own_keys, own_before)
                yield before, hits if old is None else hits + old[a:b]

        return found

    def counting(found):
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            hits = np.concatenate([h for _, h in found(batch)])
            bounds = np.arange(len(hits) + 1, dtype=np.int32) * np.int32(len(languages))
            return [pa.ListArray.from_arrays(pa.array(bounds), pa.array(hits.ravel()))]

        return step

    def deciding(found):
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            names, scores = [], []
            for before, hits in found(batch):
                n = np.diff(before)
                if not languages:
                    names += [UNDETERMINED] * len(n)
                    scores += [0.0] * len(n)
                    continue
                shares = as_shares(hits, before)
                best = shares.argmax(axis=1)
                score = shares[np.arange(len(n)), best] / np.maximum(shares.sum(axis=1), 1e-12)
                names += [languages[i] if m else UNDETERMINED for i, m in zip(best, n)]
                scores += np.where(n > 0, score, 0.0).tolist()
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return step

    rows, last_path = docs, None
    for number in range(slices - 1):
        sent, path = spark.sparkContext.broadcast(model.slice(number)), shared_folder(spark)
        counted = added(rows, counting(pass_of(number, sent)), [StructField(so_far, ArrayType(DoubleType()))])
        rows = stored(counted, path)
        sent.destroy()
        if last_path is not None:
            dropped(spark, last_path)
        last_path = path
    sent = spark.sparkContext.broadcast(model.slice(slices - 1))
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return added(rows, deciding(pass_of(slices - 1, sent)), fields).drop(so_far)
