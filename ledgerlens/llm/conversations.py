"""Repair of conversations so that their roles alternate, at the least cost of edits.

Rows are dealt out by conversation and sorted by turn within the task, so that a conversation streams
through ``mapInPandas`` row by row, however many Arrow batches it fills. What is carried from batch to
batch is a dynamic programme over the four things the repaired text so far can end in: nothing, a
system row, a user row, an assistant row. For each of them it holds the least cost, the rank of the
edits among those of the others, and the running SHA-256 of the repaired text, so no text is kept. Of
every row four bytes stay, which say how each end was reached. They go to a file of the task's own, gone
with the task, once a conversation has many rows, and are read backwards to spell the edits out.

Which rows repeat an earlier one is found before, by counting (conversation, role, text) in Spark, so
that no task has to remember all rows of a conversation.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shipping import ship
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import measure_size

# What the check sums decide, the costs, and the blanks.
FAULTS = 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANK = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"

SPILL_BYTES = 4 << 20  # backpointers of a conversation that stay in memory
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
OPS = "DKR"  # an edit is one of these, in the order of ties, after some inserts


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, dropped) with faults dealt out by a check sum of id and turn.

    Null values read as one space, but for conv_id and turn as keys. A dropped row stays as a sign that
    its conversation exists; a repeated one comes twice.
    """
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % FAULTS
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_spaced("text"), "[.!?]", "")).otherwise(_spaced("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(_spaced("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("dropped"),
        copies.alias("_copy"),
    )
    return rows.drop("_copy")


def _as_given(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), F.lit(False).alias("dropped"))


# Kinds of rows.
SOUND, CUT, BLANK_ROW, REPEAT, DROPPED = range(5)


def _judged(rows: DataFrame) -> DataFrame:
    """Add the first fault of each row as ``kind``; ``earlier`` rows make repeats, also blank ones.

    Rows of one conversation and turn are in order of role and text, so the first of equal rows is the
    one that comes first in the stream; ``_first`` is the turn (null before all) at which it does.
    """
    rows = rows.withColumns(
        {
            "_conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
            "_anonymous": F.col("conv_id").isNull(),
            "_content": F.when(~F.col("dropped"), F.md5(F.concat_ws(":", F.length("role"), "role", "text"))),
            "_turn": F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")),
        }
    )
    key = ["_conv", "_anonymous", "_content"]
    repeated = rows.where("not dropped").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("_turn").alias("_first"))
    repeated = measure_size(repeated.where("n > 1").drop("n"), "repeated_turns")
    marked = sized_join(rows, repeated, key, ["turn"])
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    return marked.select(
        "conv_id",
        "turn",
        "role",
        F.when(F.col("dropped"), "").otherwise(F.col("text")).alias("text"),
        F.when(F.col("dropped"), DROPPED)
        .when(~F.col("text").rlike(BLANK), BLANK_ROW)
        .when(F.col("_first") < F.col("_turn"), REPEAT)
        .when(~last.isin(".", "!", "?"), CUT)
        .otherwise(SOUND)
        .alias("kind"),
    )


# The dynamic programme


class Step(NamedTuple):
    """How an end is reached from an earlier one: edits, their cost, and the pointer that says so."""

    before: int
    after: int
    cost: int
    edits: str  # inserts, then the edit of the row
    pointer: int
    inserted: tuple[int, ...]


def _next(end: int, initial: str) -> int | None:
    """The end after one more row, or None if no such row may follow."""
    if initial == "s":
        return SYSTEM if end == NONE else None
    if initial == "u":
        return USER if end != USER else None
    return ASSISTANT if initial == "a" and end == USER else None


def _inserts(end: int, n: int) -> tuple[int, ...]:
    """The ends that ``n`` inserted rows lead to; what may be inserted is settled by the end before."""
    ends = []
    for _ in range(n):
        end = ASSISTANT if end == USER else USER
        ends.append(end)
    return tuple(ends)


@cache
def steps(initial: str, kind: int) -> list[Step]:
    """All useful edits of a row with the role's initial.

    Up to two inserts before it: a third leads to where the first did. None before a delete, after
    which they cost the same and sort earlier. No new role where the row's own would do.
    """
    found = []
    late = TRUNCATED if kind == CUT else 0
    for before in range(4):
        found.append(Step(before, before, DELETE, "D", before, ()))
        if kind in (BLANK_ROW, REPEAT):
            continue
        for n in range(3):
            inserted = _inserts(before, n)
            end = inserted[-1] if n else before
            for op, letter, cost in (("K", initial, KEEP), ("R", "a" if end == USER else "u", REROLE)):
                after = _next(end, letter)
                if after is not None:
                    pointer = before | n << 2 | OPS.index(op) << 4
                    found.append(Step(before, after, cost + late + n * INSERT, "I" * n + op, pointer, inserted))
    return found


LAST_INSERTS = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


class Pointers:
    """Four bytes a row; in a file of the task once they are many. The file is closed with the conversation."""

    def __init__(self):
        self.tail, self.file, self.blocks = bytearray(), None, 0

    def add(self, four: list[int]) -> None:
        self.tail += bytes(four)
        if len(self.tail) >= SPILL_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.blocks += 1
            self.tail = bytearray()

    def backwards(self) -> Iterator[bytes]:
        yield bytes(self.tail)
        size = -(-SPILL_BYTES // 4) * 4
        for block in reversed(range(self.blocks)):
            self.file.seek(block * size)
            yield self.file.read(size)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Repair:
    """One conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.least = self.most = self.turn = None
        self.turns = 0
        self.counts = [0] * 5
        self.illegal = 0
        self.initial = None
        self.before = None
        # By end: (cost, rank of the edits) or None, and the running hash with whether it has rows.
        self.ends = [(0, 0), None, None, None]
        self.hashes = [(hashlib.sha256(), False), None, None, None]
        self.pointers = Pointers()

    def row(self, turn, role: str, text: str, kind: int) -> None:
        if kind == DROPPED:
            return
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.turns += 1
        # The one before it in order: of equal rows of a turn all but the first repeat.
        same, self.before = self.before == (turn, role, text), (turn, role, text)
        if same and kind != BLANK_ROW:
            kind = REPEAT
        self.counts[kind] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self._extend(initial if initial in ("s", "u", "a") else "", kind, role, text)

    def _extend(self, initial: str, kind: int, role: str, text: str) -> None:
        best: list = [None] * 4
        for step in steps(initial, kind):
            end = self.ends[step.before]
            if end is not None:
                candidate = (end[0] + step.cost, end[1], step.edits, step)
                if best[step.after] is None or candidate[:3] < best[step.after][:3]:
                    best[step.after] = candidate
        order = sorted((c[1:3], i) for i, c in enumerate(best) if c is not None)
        rank = {i: n for n, (_, i) in enumerate(order)}
        hashes = [c and self._hashed(c[3], role, text) for c in best]
        self.pointers.add([c[3].pointer if c else 0 for c in best])
        self.ends = [c and (c[0], rank[i]) for i, c in enumerate(best)]
        self.hashes = hashes

    def _hashed(self, step: Step, role: str, text: str):
        digest, started = self.hashes[step.before]
        op = step.edits[-1]
        if op == "D":
            return digest, started  # hashes are copied before they grow
        digest = digest.copy()
        for end in step.inserted:
            digest.update(f"{chr(10) if started else ''}{ROLES[end]}:".encode())
            started = True
        kept = role if op == "K" else ROLES[step.after]
        digest.update(f"{chr(10) if started else ''}{kept}:{text}".encode())
        return digest, True

    def result(self) -> tuple:
        closing = []
        for end, found in enumerate(self.ends):
            if found is not None:
                n = LAST_INSERTS[end]
                closing.append((found[0] + n * INSERT, found[1], n, end))
        cost, _, n, end = min(closing)
        digest, started = self.hashes[end]
        digest = digest.copy()
        for inserted in _inserts(end, n):
            digest.update(f"{chr(10) if started else ''}{ROLES[inserted]}:".encode())
            started = True
        audit = self._audit(end) + "I" * n
        self.pointers.close()
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        c = self.counts
        return (self.conv_id, gaps, c[BLANK_ROW], c[REPEAT], c[CUT], self.illegal, cost, audit, digest.hexdigest())

    def _audit(self, end: int) -> str:
        """The edits, spelled from the last row to the first, a block of pointers at a time."""
        blocks = []
        for block in self.pointers.backwards():
            letters = []
            for at in range(len(block) - 4, -1, -4):
                pointer = block[at + end]
                letters.append(OPS[pointer >> 4] + "I" * (pointer >> 2 & 3))
                end = pointer & 3
            blocks.append("".join(letters)[::-1])
        return "".join(reversed(blocks))


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, done = None, []
    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv_id", "turn", "role", "text", "kind")]
        for conv_id, turn, role, text, kind in zip(*columns, strict=True):
            conv_id = None if pd.isna(conv_id) else conv_id
            if current is None or conv_id != current.conv_id:
                if current:
                    done.append(current.result())
                current = Repair(conv_id)
            current.row(None if pd.isna(turn) else int(turn), role, text, kind)
        if done:
            yield pd.DataFrame(done, columns=NAMES)
            done = []
    if current:
        yield pd.DataFrame([current.result()], columns=NAMES)


def repair(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """One row for every conv_id of ``conversations`` (conv_id, turn, role, text): faults, cost and edits.

    ``damage`` first deals out faults (``damaged``). Rows of a conversation are taken by turn, nulls
    first, those of equal turn by role and text. ``gaps`` are turns missing between the least and the
    greatest; ``blank``, ``duplicate`` and ``truncated`` count rows by their first fault, ``illegal``
    neighbours whose roles may not follow each other. Keeping a row costs 0, another role 2, a delete 3, a
    row put in 2, and a truncated row that stays 1; blank and duplicate rows must go. ``audit`` has the
    initials of the cheapest edits, of equally cheap ones those that sort first, by which the roles become
    an optional system row and pairs of user and assistant, or nothing. ``repaired_sha256`` is the hash of
    the repaired rows ``role:text``, a line each.

    A null role or text reads as one space, so such a row is blank or needs a role; a null turn counts
    for no gap; rows with a null conv_id are one conversation. Repeated rows are duplicates. A
    conversation without rows after the damage has zeros, no edits and the hash of nothing; an empty
    table gives an empty result. Other columns are not read. A conversation is one stream of one task, in
    bounded memory but for its ``audit``, a letter a row.
    """
    spark = conversations.sparkSession
    ship(spark)
    rows = _judged(damaged(conversations) if damage else _as_given(conversations))
    stream = rows.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
    )
    # Numbers with nulls would become floats in pandas; as text they keep all digits.
    of = conversations.schema["conv_id"].dataType.simpleString()
    stream = stream.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "kind")
    counts = ", ".join(f"{n} long" for n in NAMES[1:7])
    result = stream.mapInPandas(_streamed, f"conv_id string, {counts}, audit string, repaired_sha256 string")
    return result.withColumn("conv_id", F.col("conv_id").cast(of))
