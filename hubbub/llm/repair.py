"""Repair of conversation structure by Wagner-Fischer alignment with the alternating grammar.

A conversation should read ``(s?(ua)+)?`` in role initials: perhaps a system turn, then user and assistant
in turn. Each row's first fault counts: blank, duplicate (role and text seen earlier in the conversation)
or truncated. Edits are Keep (0), Rerole to user or assistant (3), Delete (4; required for blank and
duplicate rows) and Insert of an empty user or assistant turn (3); a truncated row that stays adds 3. The
``audit`` lists the cheapest edits by their initials, of equally cheap ones the least in ASCII order.

Rows are sorted by conversation and turn over all tasks, and cut into blocks of at most ``BLOCK_ROWS`` rows,
so no task needs a whole conversation. A block is aligned, from each phase of the grammar it may be entered
in, with the grammar string of every length within reach: one Wagner-Fischer table per string serves all
its lengths, as they are prefixes of one another. A first walk through the block gives an incumbent cost;
the table is only filled in the Ukkonen band that this cost leaves (an insertion costs 3, a deletion 4, or
1 more where the row is truncated). Alignments that cost the same are compared by their backtraced audits.
A block's audit ends with one of its rows, insertions belong to the row after them, so audits of blocks
compare like audits of conversations. What remains per block is a cost and an audit for each phase in and
out; a conversation's cheapest way through its blocks follows from these. Texts are then read once more,
in order, to hash the repaired rows; a digest needs one reader, which keeps an audit and one batch.

Defined cases. A null role or text is one space, so blank. Rows of one turn are ordered by role, then by
the SHA-256 of their text; null turns come first. An empty role has no initial and fits nowhere: its row
is reroled or deleted. Repeated rows are duplicates. A null ``conv_id`` is a conversation of its own. A
conversation without rows has zeros, an empty audit and the digest of the empty string. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubbub.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_ROWS = 128
#: Phases of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What ends a conversation in each phase.
CLOSING = ("", "II", "I", "")
WORD = "[^\\x20\\x09-\\x0D]"

#: Bits of a row's fault.
FORCED, CUT_OFF = 1, 2


def incumbent(rows: list[tuple[str, int]], phase: int) -> int:
    """A cost at which both phases, after a user and after an assistant turn, can be left."""
    costs = []
    for ahead in (1, 2):
        cost, now = INSERT * ahead, phase
        for _ in range(ahead):
            now = ASSISTANT if now == USER else USER
        for initial, fault in rows:
            if fault & FORCED:
                cost += DELETE
                continue
            fits = initial == ("a" if now == USER else "u")
            cost += (KEEP if fits else REROLE) + (TRUNCATED if fault & CUT_OFF else 0)
            now = ASSISTANT if now == USER else USER
        costs.append(cost)
    return max(costs)


def aligned(rows: list[tuple[str, int]], phase: int) -> dict[int, tuple[int, str]]:
    """The cheapest (cost, audit) of a block for each phase it can be left in, entered in ``phase``."""
    best: dict[int, tuple[int, str]] = {}

    def offer(out: int, cost: int, audit: str) -> None:
        if out not in best or (cost, audit) < best[out]:
            best[out] = cost, audit

    n = len(rows)
    if phase in (START, SYSTEM):
        offer(phase, DELETE * n, "D" * n)
    limit = incumbent(rows, phase)
    first = "a" if phase == USER else "u"
    _align(rows, "", first, limit, phase, offer)
    if phase == START and any(c == "s" and not fault & FORCED for c, fault in rows):
        for i, (c, fault) in enumerate(rows):
            if c == "s" and not fault & FORCED:
                cost = DELETE * (n - 1) + (TRUNCATED if fault & CUT_OFF else 0)
                offer(SYSTEM, cost, "D" * i + "K" + "D" * (n - 1 - i))
        _align(rows, "s", "u", limit, phase, offer)
    return best


def _align(rows, head: str, first: str, limit: int, phase: int, offer) -> None:
    """Offers the best alignments with ``head`` and then ``first`` and its opposite in turn, of any length.

    One table serves all lengths: a shorter target is a prefix of a longer one. A cell is filled only
    where the way to it can cost ``limit`` or less.
    """
    n, second = len(rows), "a" if first == "u" else "u"
    spare = limit
    cut = sum(1 for _, fault in rows if fault == CUT_OFF)
    spare -= sum(DELETE if fault & FORCED else TRUNCATED if fault & CUT_OFF else 0 for _, fault in rows)
    if spare < 0:
        return
    above = spare // INSERT
    below = min(spare, cut) + (spare - min(spare, cut)) // DELETE
    far = limit + 1
    target = head + (first + second) * (n + above + 2)

    def leaves(length: int) -> int:
        if length == 0:
            return phase
        if head and length == 1:
            return SYSTEM
        return USER if target[length - 1] == "u" else ASSISTANT

    table: list[dict[int, int]] = []
    diagonal = 0
    row = {0: 0}
    for i in range(n + 1):
        high = diagonal + above
        low = max(0, diagonal - below)
        if i:
            initial, fault = rows[i - 1]
            old, row = table[-1], {}
            for j in range(low, high + 1):
                cost = old.get(j, far) + DELETE
                if j and not fault & FORCED and (j - 1) in old:
                    wanted = target[j - 1]
                    if initial == wanted or wanted != "s":
                        step = (KEEP if initial == wanted else REROLE) + (TRUNCATED if fault & CUT_OFF else 0)
                        cost = min(cost, old[j - 1] + step)
                if cost <= limit:
                    row[j] = cost
        if i < n:  # insertions before the next row
            for j in range(low + 1, high + 1):
                if (j - 1) in row and target[j - 1] != "s":
                    cost = row[j - 1] + INSERT
                    if cost <= limit and cost < row.get(j, far):
                        row[j] = cost
            if not rows[i][1] & FORCED:
                diagonal += 1
        table.append(row)

    for out in (USER, ASSISTANT):
        lengths = [j for j in table[n] if leaves(j) == out]
        if not lengths:
            continue
        cost = min(table[n][j] for j in lengths)
        offer(out, cost, _least_audit(rows, target, table, [j for j in lengths if table[n][j] == cost]))


def _least_audit(rows, target: str, table: list[dict[int, int]], ends: list[int]) -> str:
    """The least audit of all cheapest alignments that end in one of ``ends``."""
    n = len(rows)
    marked = [set() for _ in range(n + 1)]
    steps: dict[tuple[int, int], list[tuple[str, int, int]]] = {}
    todo = [(n, j) for j in ends]
    marked[n].update(ends)
    while todo:  # backwards over every edge of a cheapest way
        i, j = todo.pop()
        cost = table[i][j]
        ways = []
        if i:
            initial, fault = rows[i - 1]
            if table[i - 1].get(j, -1) + DELETE == cost and j in table[i - 1]:
                ways.append(("D", i - 1, j))
            if j and not fault & FORCED and (j - 1) in table[i - 1]:
                wanted = target[j - 1]
                extra = TRUNCATED if fault & CUT_OFF else 0
                if initial == wanted and table[i - 1][j - 1] + KEEP + extra == cost:
                    ways.append(("K", i - 1, j - 1))
                elif initial != wanted and wanted != "s" and table[i - 1][j - 1] + REROLE + extra == cost:
                    ways.append(("R", i - 1, j - 1))
        if i < n and j and target[j - 1] != "s" and (j - 1) in table[i] and table[i][j - 1] + INSERT == cost:
            ways.append(("I", i, j - 1))
        for letter, a, b in ways:
            steps.setdefault((a, b), []).append((letter, i, j))
            if b not in marked[a]:
                marked[a].add(b)
                todo.append((a, b))
    audit, at = [], (0, 0)
    while at in steps:
        letter, *to = min(steps[at])
        audit.append(letter)
        at = tuple(to)
    return "".join(audit)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the hash of ``conv_id:turn``; ``copies`` is 0 for a dropped row."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def last_character(text: Column) -> Column:
    """The last character that is not white space, or an empty string."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def _blocks(conv_type: pa.DataType):
    """Blocks of sorted rows, each with its faults, and costs, ranks and audits by phase in and out."""

    names = ["conv_id", "part", "block", "n", "blank", "duplicate", "truncated", "costs", "audits"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, whose, rows, counts, opens, out = TaskContext.get().partitionId(), 0, None, [], [0, 0, 0], False, []
        last, begun = None, False

        def close(conv) -> None:
            nonlocal number
            phases = (START,) if opens else (START, SYSTEM, USER, ASSISTANT)
            costs, audits = [-1] * 16, [""] * 16
            for phase in phases:
                for leave, (cost, audit) in aligned(rows, phase).items():
                    costs[4 * phase + leave], audits[4 * phase + leave] = cost, audit
            out.append((conv, part, number, len(rows), *counts, costs, audits))
            number += 1

        def batch_of() -> pa.RecordBatch:
            kinds = [conv_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for conv, turn, role, digest, initial, blank, ended, again, copies in zip(*[c.to_pylist() for c in batch.columns]):
                if not begun or conv != whose:
                    if rows:
                        close(whose)
                    # The first conversation of a task may have begun in another one.
                    opens, whose, rows, counts = begun, conv, [], [0, 0, 0]
                    begun = True
                for _ in range(copies):
                    this = conv, turn, role, digest
                    kind = 0 if blank else 1 if again or this == last else 2 if not ended else 3
                    if kind < 3:
                        counts[kind] += 1
                    rows.append((initial, FORCED if kind < 2 else CUT_OFF if kind == 2 else 0))
                    last = this
                    if len(rows) == BLOCK_ROWS:
                        close(whose)
                        opens, rows, counts = False, [], [0, 0, 0]
            if out:
                yield batch_of()
                out = []
        if rows:
            close(whose)
        if out:
            yield batch_of()

    return run


def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phases in which the cheapest way enters and leaves each block of a conversation."""
    for batch in batches:
        out = []
        for blocks in batch.column(0).to_pylist():
            blocks.sort(key=lambda b: (b["part"], b["block"]))
            ahead = [{START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}]
            for b in reversed(blocks):
                togo = {}
                for phase in range(4):
                    ways = [
                        b["costs"][4 * phase + leave] + ahead[-1][leave]
                        for leave in range(4)
                        if b["costs"][4 * phase + leave] >= 0 and leave in ahead[-1]
                    ]
                    if ways:
                        togo[phase] = min(ways)
                ahead.append(togo)
            ahead.reverse()
            phase = START
            for at, b in enumerate(blocks):
                leaves = [
                    (b["ranks"][4 * phase + leave], leave)
                    for leave in range(4)
                    if b["costs"][4 * phase + leave] >= 0
                    and leave in ahead[at + 1]
                    and b["costs"][4 * phase + leave] + ahead[at + 1][leave] == ahead[at][phase]
                ]
                leave = min(leaves)[1]
                out.append((b["part"], b["block"], 4 * phase + leave, at == len(blocks) - 1))
                phase = leave
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*out)], names=["part", "block", "way", "final"]
            )


def _ranks(audits: Column) -> Column:
    """The rank of each audit among all of its block, so that audits need not be carried along."""
    ordered = F.array_sort(F.array_distinct(audits))
    return F.transform(audits, lambda a: F.array_position(ordered, a).cast("int"))


def _replayed(conv_type: pa.DataType):
    """One row per conversation, from its blocks and then its rows, in order."""
    result = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    class Conversation:
        def __init__(self, conv):
            self.conv, self.counts, self.cost, self.pieces = conv, [0, 0, 0], 0, []
            self.turns, self.low, self.high, self.distinct = None, None, None, 0
            self.illegal, self.before, self.at, self.phase = 0, None, 0, START
            self.audit, self.digest, self.lines = None, hashlib.sha256(), 0

        def put(self, role: str, text: str) -> None:
            self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
            self.lines += 1

        def insert(self) -> None:
            """The inserted turns that come next."""
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.at += 1
                self.step(None)
                self.put("assistant" if self.phase == ASSISTANT else "user", "")

        def step(self, initial) -> None:
            self.phase = SYSTEM if initial == "s" else ASSISTANT if self.phase == USER else USER

        def row(self, turn, role, text, initial) -> None:
            if self.audit is None:
                self.audit = "".join(self.pieces)
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.distinct += turn != self.high
                self.high = turn
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            self.insert()
            letter, self.at = self.audit[self.at], self.at + 1
            if letter == "D":
                return
            self.step(initial if letter == "K" else None)
            if letter == "R":
                role = "assistant" if self.phase == ASSISTANT else "user"
            self.put(role, text)

        def ended(self) -> tuple:
            if self.audit is None:
                self.audit = "".join(self.pieces)
            self.insert()
            gaps = 0 if self.high is None else self.high - self.low + 1 - self.distinct
            return self.conv, gaps, *self.counts, self.illegal, self.cost, self.audit, self.digest.hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def batch_of() -> pa.RecordBatch:
            kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=result)

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now.conv:
                    if now is not None:
                        out.append(now.ended())
                    now = Conversation(r["conv_id"])
                if r["audit"] is not None:
                    now.pieces.append(r["audit"])
                    now.cost += r["cost"]
                    now.counts = [a + r[c] for a, c in zip(now.counts, ("blank", "duplicate", "truncated"))]
                    continue
                for _ in range(r["copies"]):
                    now.row(r["turn"], r["role"], r["text"], r["initial"])
            if out:
                yield batch_of()
                out = []
        if now is not None:
            out.append(now.ended())
            yield batch_of()

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: faults, the cheapest edits and the digest of the repaired conversation.

    ``rows`` has ``conv_id, turn, role, text`` and perhaps ``copies``: how often a row stands there, 0
    for a row that is gone but whose conversation is still reported.
    """
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    types = dict(rows.dtypes)
    arrow_type = pa.string() if types["conv_id"] == "string" else pa.int64()
    conv = types["conv_id"] if types["conv_id"] == "string" else "long"
    said = rows.select(
        F.col("conv_id").cast(conv).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("int").alias("copies"),
    ).withColumns({"initial": F.substring("role", 1, 1), "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256))})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]

    facts = said.where(F.col("copies") > 0).select(
        "conv_id",
        "turn",
        "role",
        "digest",
        "initial",
        (~F.col("text").rlike(WORD)).alias("blank"),
        last_character(F.col("text")).isin(".", "!", "?").alias("ended"),
        "copies",
    )
    same = ["conv_id", "turn", "role", "digest", "initial", "blank", "ended"]
    facts = facts.groupBy(*same).agg(F.sum("copies").cast("int").alias("copies"))
    # What is said in several turns: its first turn, where null comes first.
    spread = (
        facts.groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("_low"), F.max("turn").alias("_high"), F.count(F.lit(1)).alias("_n"), F.count("turn").alias("_k"))
        .where((F.col("_low") < F.col("_high")) | ((F.col("_n") > F.col("_k")) & (F.col("_k") > 0)))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("role").alias("_role"),
            F.col("digest").alias("_digest"),
            F.when(F.col("_n") == F.col("_k"), F.col("_low")).alias("_first"),
        )
    )
    match = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    )
    seen = F.col("_conv").isNotNull() | F.col("_role").isNotNull()
    again = seen & F.coalesce(F.col("_first") < F.col("turn"), F.col("_first").isNull() & F.col("turn").isNotNull())
    marked = facts.join(spread, match, "left").select(
        "conv_id", "turn", "role", "digest", "initial", "blank", "ended", again.alias("again"), "copies"
    )
    block_type = (
        f"conv_id {conv}, part long, block long, n long, blank long, duplicate long, truncated long, "
        "costs array<long>, audits array<string>"
    )
    blocks = written(marked.orderBy(*order).mapInArrow(_blocks(arrow_type), block_type).withColumn("ranks", _ranks(F.col("audits"))))

    ways = (
        blocks.groupBy("conv_id")
        .agg(F.collect_list(F.struct("part", "block", "costs", "ranks")).alias("blocks"))
        .select("blocks")
        .mapInArrow(_chosen, "part long, block long, way long, final boolean")
    )
    at = (F.col("way") + 1).cast("int")
    closing = F.element_at(F.array(*[F.lit(c) for c in CLOSING]), (F.col("way") % 4 + 1).cast("int"))
    closing = F.when(F.col("final"), closing).otherwise(F.lit(""))
    pieces = blocks.join(ways, ["part", "block"]).select(
        "conv_id",
        "part",
        "block",
        "blank",
        "duplicate",
        "truncated",
        (F.element_at("costs", at) + F.length(closing) * INSERT).alias("cost"),
        F.concat(F.element_at("audits", at), closing).alias("audit"),
    )
    lines = said.select("conv_id", "turn", "role", "text", "copies", "initial", "digest")
    together = pieces.unionByName(lines, allowMissingColumns=True)
    dealt = together.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(),
        F.col("audit").isNull(),
        "part",
        "block",
        F.col("turn").asc_nulls_first(),
        "role",
        "digest",
    )
    result_type = (
        f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return dealt.drop("digest", "part", "block").mapInArrow(_replayed(arrow_type), result_type)
