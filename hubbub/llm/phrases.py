"""Collocations of each language, counted by multikey quicksort of suffix pointers.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+``. Every word with another one after it begins a suffix, cut after ``longest`` words or at
the end of its piece. Suffixes go to buckets by language and their two leading words, equal ones of a chunk
of texts already added up; those of a bucket travel as one block of lines. In a bucket a multikey three-way
quicksort orders pointers to the suffixes, word by word to the full depth: the pointers equal to the pivot
at depth d share their first d words, so their weight is the count of that phrase. A part below ``least`` is
given up at once, with all its longer phrases.

All suffixes of two leading words meet in one bucket, so counts there are whole. A first pass counts single
words; their number sets the number of buckets, so that a bucket holds some ``BUCKET_WORDS`` words at any
size of the corpus. It also notes leading words that are much of a whole chunk (the ``HOT`` most frequent
ones are taken). These are spread over ``SALTS`` buckets by their third word: a phrase longer than the lead
is still whole in one place, and the counts of the lead itself are added up afterwards.

``candidates`` are phrases of two words or more with at least ``least`` occurrences. A cut after the first
k words has the score floor(10^6 a^2 / (l r)), in decimal arithmetic, exact for counts below 10^16; the
lowest score of all cuts counts, of equal ones the first. A candidate is dropped where a longer candidate
that holds it has at least half its count. Null texts are empty, a null language is ``und``, so the two
are one language. Repeated rows count again. Ties go by count, then by the phrase's bytes. Other columns
are ignored. An empty table, and one whose phrases are all rare, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubbub.llm.common import Words, ascii_lowered, byte_set, mixed, odd_weights, text_bytes, written

LONGEST, LEAST, TOP = 3, 10, 2000
#: Most leading words that are spread, the places of each, and the share of a chunk that makes one hot.
HOT, SALTS, HOT_SHARE = 4096, 64, 1 / 2048
#: Bytes of text whose suffixes are added up together, words of the corpus per bucket, and single words
#: that a task adds up before it passes them on.
CHUNK_BYTES, BUCKET_WORDS, MOST_SINGLE = 1 << 22, 1 << 18, 1 << 18
#: Below this many pointers a part is put in order at once instead of being split further.
SMALL = 4096

_BREAKS = byte_set((0x0A, 0x0D)) | np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
_IN_WORD = ~(_BREAKS | byte_set((0x20, 0x20), (0x09, 0x09)))
_LOWERED = ascii_lowered()


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Word numbers of all texts on end, the words, the text of each, and how many follow in its piece."""
    data, offsets = text_bytes(column)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IN_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(opens)
    if len(starts) == 0:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept = np.ascontiguousarray(_LOWERED[data[inside[:-1]]])
    ends = np.append((np.cumsum(inside[:-1], dtype=np.int32) - 1)[starts], np.int32(len(kept)))
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(kept))
    encoded = words.dictionary_encode()
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    # A piece ends with its text, or where a break lies between two words.
    breaks = np.append(np.int32(0), np.cumsum(_BREAKS[data], dtype=np.int32))[starts]
    final = np.append((breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1]), True)
    last = np.flatnonzero(final)
    follow = np.repeat(last, np.diff(np.append(-1, last))) - np.arange(len(starts))
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary, text, follow


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Languages and texts of about ``CHUNK_BYTES`` each."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(1))).as_py() or 0
            if size >= CHUNK_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    whole = pa.Table.from_batches(held).combine_chunks()
    return whole.column(0).combine_chunks(), whole.column(1).combine_chunks()


def _runs(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Each different combination of keys (-1 or more), and how often it stands."""
    sizes = [int(key.max(initial=0)) + 2 for key in keys]
    if math.prod(sizes) >= 1 << 62:
        found = pa.table([pa.array(k) for k in keys], names=[str(i) for i in range(len(keys))])
        found = found.group_by(found.column_names).aggregate([([], "count_all")])
        return [found.column(str(i)).to_numpy() for i in range(len(keys))], found.column("count_all").to_numpy()
    code = keys[0] + 1
    for key, size in zip(keys[1:], sizes[1:]):
        code = code * size + key + 1
    found = pc.value_counts(pa.array(code))
    code, out = found.field(0).to_numpy(), []
    for size in sizes[:0:-1]:
        code, rest = np.divmod(code, size)
        out.append(rest - 1)
    return [code - 1, *out[::-1]], found.field(1).to_numpy()


def _local(langs: pa.Array, texts: pa.Array):
    """Word numbers, words, language numbers of words, languages and what follows in the piece."""
    ids, words, text, follow = words_of(texts)
    coded = langs.dictionary_encode()
    return ids, words, coded.indices.to_numpy().astype(np.int64)[text], coded.dictionary, follow


def single_words(docs: DataFrame) -> DataFrame:
    """``lang, phrase, hot, a``: words with their counts, and each chunk's leading word pairs of note."""
    names = ["lang", "phrase", "hot", "a"]

    def rows(lang, phrase, hot, n):
        return pa.table([lang, phrase, pa.array(np.full(len(n), hot)), pa.array(n, pa.int64())], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for langs, texts in chunks(batches):
            ids, words, lang, named, follow = _local(langs, texts)
            (of, word), n = _runs(lang, ids)
            held.append(rows(named.take(pa.array(of)), words.take(pa.array(word)), False, n))
            lead = np.flatnonzero(follow >= 1)
            (of, first, second), n = _runs(lang[lead], ids[lead], ids[lead + 1])
            at = np.flatnonzero(n >= HOT_SHARE * len(ids))
            phrase = pc.binary_join_element_wise(words.take(pa.array(first[at])), words.take(pa.array(second[at])), " ")
            held.append(rows(named.take(pa.array(of[at])), phrase, True, n[at]))
            if sum(t.num_rows for t in held) >= MOST_SINGLE:
                held = [pa.concat_tables(held).group_by(names[:3]).aggregate([("a", "sum")]).rename_columns(names)]
                if held[0].num_rows >= MOST_SINGLE // 2:
                    yield from held.pop().combine_chunks().to_batches()
        if held:
            whole = pa.concat_tables(held).group_by(names[:3]).aggregate([("a", "sum")]).rename_columns(names)
            yield from whole.combine_chunks().to_batches()

    return docs.mapInArrow(run, "lang string, phrase string, hot boolean, a long")


def _named(words: pa.Array) -> np.ndarray:
    """A number for each string, the same in all tasks; equal numbers only share a bucket."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Words(np.ones(256, bool), np.arange(256, dtype=np.uint8)).names(data, at[:-1] - at[0], at[1:] - at[0])


def _lead_names(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    a, b, c = odd_weights(3)
    return mixed(lang * a + first * b + second * c)


def suffixes(docs: DataFrame, longest: int, buckets: int, hot: list[tuple[str, str]]) -> DataFrame:
    """``bucket, salted, lang, lines, a``: suffixes of a chunk, equal ones added up, by bucket.

    ``lines`` has the words of a suffix on each line, ``a`` their counts as 32-bit numbers.
    """
    split = [pair.split(" ") for _, pair in hot]
    noted = [pa.array(x, pa.string()) for x in ([lang for lang, _ in hot], [p[0] for p in split], [p[1] for p in split])]
    noted = np.unique(_lead_names(*[_named(x) for x in noted]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in chunks(batches):
            ids, words, lang, named, follow = _local(langs, texts)
            lead = np.flatnonzero(follow >= 1)
            if len(lead) == 0:
                continue
            steps = [lang[lead], ids[lead], ids[lead + 1]]
            padded = np.concatenate([ids, np.full(longest, -1)])
            steps += [np.where(follow[lead] >= d, padded[lead + d], -1) for d in range(2, longest)]
            steps, n = _runs(*steps)
            word_name = np.append(_named(words), np.uint64(0))  # the last one stands for no word
            place = _lead_names(_named(named)[steps[0]], word_name[steps[1]], word_name[steps[2]])
            salted = np.isin(place, noted)
            if longest > 2:
                place = np.where(salted, mixed(place + word_name[steps[3]] % np.uint64(SALTS)), place)
            bucket = (place % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((steps[2], steps[1], steps[0], salted, bucket))
            bucket, salted, n, steps = bucket[order], salted[order], n[order], [x[order] for x in steps]
            new = np.append(True, (np.diff(bucket) != 0) | (salted[1:] != salted[:-1]) | (np.diff(steps[0]) != 0))
            at = np.flatnonzero(new)
            ends = np.append(at, len(n))
            taken = [words.take(pa.array(x, mask=x < 0)) for x in steps[1:]]
            line = pc.binary_join_element_wise(taken[0], taken[1], " ")
            for word in taken[2:]:
                longer = pc.binary_join_element_wise(line, word, " ")
                line = pc.if_else(pc.is_null(word), line, longer)
            counts = n.astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[at]),
                    pa.array(salted[at]),
                    named.take(pa.array(steps[0][at])),
                    pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), line), "\n"),
                    pa.array([counts[4 * i : 4 * j] for i, j in zip(ends, ends[1:])], pa.binary()),
                ],
                names=["bucket", "salted", "lang", "lines", "a"],
            )

    return docs.mapInArrow(run, "bucket long, salted boolean, lang string, lines string, a binary")


def quicksorted(
    keys: list[np.ndarray], weight: np.ndarray, least: int, names: np.ndarray | None = None
) -> Iterator[tuple[int, int, int]]:
    """(depth, a pointer, count) of every prefix whose weight is ``least`` or more.

    ``keys[d]`` holds the word at depth d behind each pointer, negative where the suffix has ended.
    Multikey quicksort: pointers are split by their word into less, equal and greater; the equal part
    goes one word deeper, and every part below ``least`` is given up.
    """
    todo = [(0, np.arange(len(weight)))]
    while todo:
        depth, pointers = todo.pop()
        word = keys[depth][pointers]
        if len(pointers) > SMALL:
            pivot = word[len(word) // 2]
            equal = pointers[word == pivot]
            for side in (pointers[word < pivot], pointers[word > pivot]):
                if len(side) and weight[side].sum() >= least:
                    todo.append((depth, side))
            parts = [(pivot, equal, int(weight[equal].sum()))]
        else:
            order = np.argsort(word, kind="stable")
            pointers, word = pointers[order], word[order]
            at = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.add.reduceat(weight[pointers], at)
            enough = np.flatnonzero(counts >= least)
            bounds = np.append(at, len(word))
            parts = [(word[at[p]], pointers[bounds[p] : bounds[p + 1]], int(counts[p])) for p in enough]
        for pivot, equal, count in parts:
            if pivot < 0 or count < least:
                continue
            yield depth, int(equal[0] if names is None else names[equal[0]]), count
            if depth + 1 < len(keys):
                todo.append((depth + 1, equal))


def counted(rows: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang, phrase, a`` of the phrases of two words or more, from blocks in the order of their bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(bucket)]):
                if held and bucket[low] != current:
                    yield from of_bucket(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(low, high - low))
                current = bucket[low]
        if held:
            yield from of_bucket(pa.Table.from_batches(held))

    def of_bucket(blocks: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = pc.split_pattern(blocks.column(3).combine_chunks(), "\n")
        size = lists.value_lengths().to_numpy()
        lines = lists.flatten()
        weight = np.frombuffer(b"".join(blocks.column(4).to_pylist()), "<i4").astype(np.int64)
        langs = blocks.column(2).combine_chunks().dictionary_encode()
        spread = np.repeat(blocks.column(1).to_numpy(), size)
        parts = pc.split_pattern(lines, " ")
        depth = parts.value_lengths().to_numpy()
        encoded = parts.flatten().dictionary_encode()
        code, begin = encoded.indices.to_numpy().astype(np.int64), np.cumsum(depth) - depth
        code = np.append(code, np.full(longest, -1))
        keys = [np.repeat(langs.indices.to_numpy(), size)]
        keys += [np.where(depth > d, code[begin + d], -1) for d in range(longest)]
        found = [f for f in quicksorted(keys, weight, least) if f[0] >= 2]
        # The lead of a spread bucket is whole only together with its others: never given up here.
        hot = np.flatnonzero(spread)
        if len(hot):
            found = [f for f in found if f[0] != 2 or not spread[f[1]]]
            found += [f for f in quicksorted([k[hot] for k in keys[:3]], weight[hot], 1, hot) if f[0] == 2]
        if not found:
            return
        depth, at, sums = (np.array(x) for x in zip(*found))
        for d in range(2, longest + 1):
            chosen = np.flatnonzero(depth == d)
            if not len(chosen):
                continue
            phrase = [encoded.dictionary.take(pa.array(keys[i + 1][at[chosen]])) for i in range(d)]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(keys[0][at[chosen]])),
                    pc.binary_join_element_wise(*phrase, " "),
                    pa.array(sums[chosen], pa.int64()),
                ],
                names=["lang", "phrase", "a"],
            )

    return rows.mapInArrow(run, "lang string, phrase string, a long")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of up to ``longest`` words with ``least`` occurrences, and words per language."""
    if longest < 2:
        raise ValueError("longest must be 2 or more")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    noted = written(single_words(texts).groupBy("lang", "phrase", "hot").agg(F.sum("a").alias("a")))
    single = noted.where(~F.col("hot")).select("lang", "phrase", "a")
    totals = single.groupBy("lang").agg(F.sum("a").alias("n"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    # A pair of words with a share of all suffixes has it in some chunk, so no hot one is missed.
    hot = noted.where("hot").orderBy(F.col("a").desc(), "lang", "phrase").limit(HOT).select("lang", "phrase")
    rows = suffixes(texts, longest, 1 + n // BUCKET_WORDS, [tuple(r) for r in hot.collect()])
    found = counted(rows.repartition("bucket").sortWithinPartitions("bucket"), longest, least)
    several = found.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    counts = written(several.unionByName(single).where(F.col("a") >= least))
    return counts, totals


def _piece_of(size: int):
    return lambda i: F.array_join(F.slice("_split", i, size), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` candidates."""
    counts, totals = phrase_counts(docs, longest, least)
    several = counts.withColumn("words", F.size(F.split("phrase", " "))).where(F.col("words") >= 2)
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("_left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("_right", F.expr("substr(phrase, length(_left) + 2)"))
    side = lambda name, to: counts.select(F.col("lang"), F.col("phrase").alias(name), F.col("a").alias(to))
    cuts = cuts.join(side("_left", "l"), ["lang", "_left"]).join(side("_right", "r"), ["lang", "_right"])
    big = lambda c: F.col(c).cast("decimal(19,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumns({"_num": big("a") * big("a") * million, "_den": big("l") * big("r")})
    cuts = cuts.withColumn("score", F.expr("_num div _den"))
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))

    parts = several.where(F.col("words") >= 3).withColumn("_split", F.split("phrase", " "))
    found = lowest
    for size in range(2, longest):
        pieces = F.transform(F.sequence(F.lit(1), F.col("words") - (size - 1)), _piece_of(size))
        inner = parts.where(F.col("words") > size).select("lang", F.explode(F.array_distinct(pieces)).alias("phrase"), "a")
        longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
        found = found.join(longer, ["lang", "phrase"], "left")
        found = found.where(F.col("_longer").isNull() | (100 * F.col("_longer") < 50 * F.col("a"))).drop("_longer")
    order = Window.partitionBy("lang").orderBy(F.col("_cut.score").desc(), F.col("a").desc(), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(F.broadcast(totals), "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("_cut.l").alias("l"),
        F.col("_cut.r").alias("r"),
        "n",
        F.col("_cut.score").alias("score"),
    )
