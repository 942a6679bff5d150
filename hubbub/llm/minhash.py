"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

Every text becomes the set of its distinct ``WIDTH``-word shingles (64-bit names). A sketch has
``BANDS * ROWS`` coordinates, filled by rounds of hashing: in each of the first rounds every shingle
falls into a random bin with a random value, and the least value of the earliest round stays; a further
round for each bin fills what is still empty. So all coordinates are filled, and the share of equal
coordinates concentrates around the similarity. Two sets at the threshold of 0.75 agree in one of the
bands with a probability over 0.99999; every band's bucket joins its members to one leader, and the
connected candidates form clusters. Inside a cluster all similarities are exact, from the full sets.

Equal sets are one node from the start, so copies never meet. A cluster of up to ``BLOCK`` sets, or
``BLOCK_SHINGLES`` shingles, is verified in one task, by sparse incidence products. A larger one is
dealt over blocks: every block is verified in itself and against the first one; then the sets outside
the cluster's largest component so far are the queries against all its blocks. Sets in the largest
component need no comparison with each other, and no pairs are listed: a block gives a spanning forest
of its links. Every link between different texts of a cluster is thereby in the components.

Null texts and texts without words have no shingles and are linked with nothing. A text of fewer words
is one shingle. Repeated rows and texts with equal sets are in one component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from hubbub.llm.common import (
    added,
    Words,
    arrow_map,
    ascii_lowered,
    byte_set,
    mixed,
    odd_weights,
    run_names,
    steps,
    text_bytes,
    written,
)
from hubbub.llm.components import components

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 60, 6
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
#: Rows in one file of an intermediate table of members, and of their sets.
MEMBERS_PER_FILE, SETS_PER_FILE = 200_000, 2_000
#: Result rows for which a further task is worth while.
ROWS_PER_FILE = 100_000
#: Size of the filter that spares most texts the shuffle: 4 MB.
FILTER_BITS = 1 << 25
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_kind() -> Words:
    return Words(~byte_set((0x09, 0x0D), (0x20, 0x20)), ascii_lowered())


def shingle_sets(kind: Words, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text."""
    starts, ends, before = kind.bounds(data, offsets)
    n = np.diff(before)
    names = kind.names(data, starts, ends)
    size = np.where(n >= WIDTH, n - WIDTH + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(bounds[-1]) + np.repeat(before[:-1] - bounds[:-1], size)
    of = np.repeat(np.arange(len(n)), size)
    out = np.zeros(len(at), np.uint64)
    long = n[of] >= WIDTH
    out[long] = run_names(names, at[long], WIDTH)
    for length in range(1, WIDTH):
        own = n[of] == length
        if own.any():
            out[own] = run_names(names, at[own], length)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = np.sort(out[a:b])
        sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b - a > 1 else own)
    return sets


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` filled coordinates per non-empty set."""
    out = np.full((len(sets), size), EMPTY, np.uint64)
    live = np.arange(len(sets))
    names, of = np.concatenate(sets), np.repeat(live, [len(s) for s in sets])
    flat = out.reshape(-1)
    for i in range(2 * size):
        hashed = mixed(names + np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (hashed & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32)
        if i < size:
            place = (((hashed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        else:
            place = i - size
        np.minimum.at(flat, of * size + place, value)
        if i < 8 or i % 8 == 7 or i >= size:
            open_rows = (out[live] == EMPTY).any(axis=1)
            if not open_rows.any():
                break
            if open_rows.sum() < 0.8 * len(live):
                live = live[open_rows]
                keep = np.zeros(len(sets), bool)
                keep[live] = True
                own = keep[of]
                names, of = names[own], of[own]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    total = (mixed(parts) * odd_weights(ROWS)).sum(axis=2, dtype=np.uint64)
    return mixed(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def content_of(own: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    a = mixed(own).sum(dtype=np.uint64)
    b = mixed(own ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + (int(b) ^ len(own)).to_bytes(8, "big")


def sketched(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, content, bands) per row; content and bands are null without shingles."""
    kind = word_kind()
    key_type = dict(docs.dtypes)[key]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(1))
        counts, contents, bands = [], [], []
        for i, j in steps(offsets):
            sets = shingle_sets(kind, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(sketches(some, BANDS * ROWS)).view(np.int64)) if some else iter(())
            for s in sets:
                counts.append(len(s))
                contents.append(content_of(s) if len(s) else None)
                bands.append(next(keys) if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(contents, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["key", "n_shingles", "content", "bands"],
        )

    schema = f"key {key_type}, n_shingles long, content binary, bands array<long>"
    return arrow_map(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), step, schema)


def with_content(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the 128-bit name of each text's set, null where it has none."""
    kind = word_kind()

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        out = []
        for i, j in steps(offsets):
            sets = shingle_sets(kind, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out += [content_of(s) if len(s) else None for s in sets]
        return [pa.array(out, pa.binary())]

    return added(docs, step, [StructField(name, BinaryType())])


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b): each member of a band's bucket with the bucket's leader."""
    rows = nodes.select(F.explode("bands").alias("band"), "content")
    leader = F.min("content").over(Window.partitionBy("band"))
    return rows.select(leader.alias("a"), F.col("content").alias("b")).where("a != b").distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from incidence products over shingles that both sides have."""
    n, m = len(left), len(right)
    vocabulary = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((n, m), np.float32)
    if not len(vocabulary):
        return out

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
        own = vocabulary[at] == flat
        return of[own], at[own]

    (row_a, at_a), (row_b, at_b) = places(left), places(right)
    width = max(256, (1 << 21) // max(n, m))
    for start in range(0, len(vocabulary), width):
        size = min(width, len(vocabulary) - start)
        x, y = np.zeros((n, size), np.float32), np.zeros((m, size), np.float32)
        a, b = (at_a >= start) & (at_a < start + size), (at_b >= start) & (at_b < start + size)
        x[row_a[a], at_a[a] - start] = 1
        y[row_b[b], at_b[b] - start] = 1
        out += x @ y.T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Whether each pair has ``100 * intersection >= percent * union``."""
    both = _overlaps(left, right).astype(np.int64)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * both >= percent * (sizes - both)


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a link matrix: the least row of each one's component, or -1."""
    none = len(links)
    rows, columns = np.arange(none), np.full(links.shape[1], none)
    while True:
        now_columns = np.minimum(columns, np.where(links, rows[:, None], none).min(axis=0))
        now_rows = np.minimum(rows, np.where(links, now_columns[None, :], none).min(axis=1))
        if (now_rows == rows).all() and (now_columns == columns).all():
            break
        rows, columns = now_rows, now_columns
    return np.where(links.any(axis=1), rows, -1), np.where(columns == none, -1, columns)


def verified(tasks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(task, side, content, shingles) to links (a, b), enough to connect what is linked.

    A task's sets of side 0 are compared with those of side 1, or with each other if it has no side 1.
    One task's rows meet in one partition, where tasks are read one after the other.
    """
    rows = tasks.repartition("task").sortWithinPartitions("task", "side").select("task", "side", "content", "shingles")

    def links_of(sides: list[list[tuple[bytes, np.ndarray]]]) -> list[tuple[bytes, bytes]]:
        left, right = sides[0], sides[1] or sides[0]
        if not left or (not sides[1] and len(left) < 2):
            return []
        to_rows, to_columns = forest(linked([s for _, s in left], [s for _, s in right], percent))
        out = [(left[r][0], left[i][0]) for i, r in enumerate(to_rows) if r >= 0 and r != i]
        return out + [(left[r][0], right[i][0]) for i, r in enumerate(to_columns) if r >= 0 and left[r][0] != right[i][0]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, found = None, [[], []], []
        for batch in batches:
            for task, side, content, shingles in zip(*batch.columns):
                task = task.as_py()
                if task != key:
                    found += links_of(sides)
                    key, sides = task, [[], []]
                sides[side.as_py()].append((content.as_py(), np.frombuffer(shingles.as_py(), np.uint64)))
            if len(found) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])
                found = []
        found += links_of(sides)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def _key_filter(members: DataFrame) -> np.ndarray:
    """A bit for each hash of a member's key; FILTER_BITS of them, whatever the number of members."""
    words = (
        members.select(F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)).alias("slot"))
        .selectExpr("slot DIV 64 AS word", "shiftleft(1L, CAST(slot % 64 AS INT)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _sets(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """The shingles of one text of each member node, beside its cluster.

    A filter of fixed size leaves out most texts of non-members before anything is shuffled; the join
    decides.
    """
    kind = word_kind()
    sent = docs.sparkSession.sparkContext.broadcast(_key_filter(members))
    key_type = dict(docs.dtypes)[key]

    def maybe(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot = batch.column(2).to_numpy()
        mask = (sent.value[slot >> 6] >> (slot & 63)) & 1
        kept = batch.filter(pa.array(mask == 1))
        return pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["key", "text"])

    hashed = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("slot")
    )
    rows = arrow_map(hashed, maybe, f"key {key_type}, text string").join(members, "key")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = text_bytes(batch.column(0))
        keep, raw = [], []
        contents = batch.column(1).to_pylist()
        for i, j in steps(offsets):
            for k, s in enumerate(shingle_sets(kind, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), i):
                if len(s) and content_of(s) == contents[k]:  # ids may repeat with other texts
                    keep.append(k)
                    raw.append(s.tobytes())
        kept = batch.take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [kept.column(1), kept.column(2), kept.column(3), pa.array(raw, pa.binary())],
            names=["content", "cluster", "blocks", "shingles"],
        )

    found = arrow_map(
        rows.select("text", "content", "cluster", "blocks"),
        step,
        "content binary, cluster binary, blocks int, shingles binary",
    )
    return found.dropDuplicates(["content"])


def clustered(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    percent: int = PERCENT,
    content: str | None = None,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row; see the module's text.

    ``content`` names a further column with the name of the row's set, as ``with_content`` gives it.
    """
    rows = written(sketched(docs, key, text))
    nodes = rows.where("content IS NOT NULL").groupBy("content").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")
    )
    clusters = components(candidates(nodes))
    first_key = rows.where("content IS NOT NULL").groupBy("content").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles")
    )
    n_members = clusters.count()
    members = written(
        clusters.select(F.col("node").alias("content"), F.col("component").alias("cluster")).join(first_key, "content"),
        1 + n_members // MEMBERS_PER_FILE,
    )
    sizes = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(block), F.sum("n_shingles") / F.lit(block * (BLOCK_SHINGLES // BLOCK))))
        .cast("int")
        .alias("blocks")
    )
    with_blocks = members.join(sizes, "cluster")
    sets = _sets(docs, with_blocks.select("key", "content", "cluster", "blocks"), key, text)
    has_large = bool(sizes.where("blocks > 1").limit(1).count())
    set_files = 1 + n_members // SETS_PER_FILE
    if has_large:
        sets = written(sets, set_files)
    own = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    task = lambda kind, i, j: F.concat_ws("/", F.lit(kind), F.hex("cluster"), i, j)
    zero = F.lit(0)
    first = sets.withColumn("block", own)
    alone = first.select(task("own", F.col("block"), F.col("block")).alias("task"), zero.alias("side"), "content", "shingles")
    if not has_large:
        links = verified(alone, percent)
    else:
        large = first.where("blocks > 1")
        anchors = large.where("block = 0").select("cluster", "content", "shingles", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("block"))
        anchored = anchors.select(task("anchor", zero, F.col("block")).alias("task"), zero.alias("side"), "content", "shingles").unionByName(
            large.where("block > 0").select(task("anchor", zero, F.col("block")).alias("task"), F.lit(1).alias("side"), "content", "shingles")
        )
        links = written(verified(alone.unionByName(anchored), percent), set_files)
        # Sets outside their cluster's largest component against all sets of the cluster.
        so_far = components(links).select(F.col("node").alias("content"), F.col("component").alias("part"))
        parts = large.select("content", "cluster", "block", "blocks").join(so_far, "content", "left").withColumn(
            "part", F.coalesce("part", "content")
        )
        top = parts.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(
            F.max_by("part", F.struct("n", "part")).alias("top")
        )
        rest = written(parts.join(top, "cluster").where("part != top").select("content", "cluster", "blocks"), 1 + n_members // MEMBERS_PER_FILE)
        rounds = rest.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("rounds"))
        queries = rest.join(rounds, "cluster").withColumn("round", F.pmod(F.xxhash64("content", F.lit(1)), F.col("rounds")).cast("int"))
        asked = queries.join(sets.select("content", "shingles"), "content").select(
            "cluster", "content", "shingles", "round", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block")
        )
        against = large.join(rounds, "cluster").select(
            "cluster", "content", "shingles", "block", F.explode(F.sequence(zero, F.col("rounds") - 1)).alias("round")
        )
        second = asked.select(task("rest", F.col("round"), F.col("block")).alias("task"), zero.alias("side"), "content", "shingles").unionByName(
            against.select(task("rest", F.col("round"), F.col("block")).alias("task"), F.lit(1).alias("side"), "content", "shingles")
        )
        links = links.unionByName(verified(second, percent))
    classes = components(links).select(F.col("node").alias("content"), F.col("component").alias("part"))
    named = classes.join(members.select("content", "key"), "content")
    least = named.groupBy("part").agg(F.min("key").alias("component_id"))
    of_node = (
        first_key.select("content", "key")
        .join(classes.join(least, "part").select("content", "component_id"), "content", "left")
        .select("content", F.coalesce("component_id", "key").alias("component_id"))
    )
    out = rows.select("key", "n_shingles", "content").join(of_node, "content", "left")
    out = out.coalesce(1 + rows.count() // ROWS_PER_FILE)  # narrow rows: no more tasks than that
    component = F.coalesce("component_id", "key")
    return out.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
        *([] if content is None else [F.col("content").alias(content)]),
    )
