"""Repair of conversation structure: turns aligned with an alternating grammar."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an edit costs; a truncated turn that is not deleted costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Role initials that may follow each other.
LEGAL = {b"su", b"ua", b"au"}
#: Audits of short conversations that a task remembers; a full memory is emptied.
MEMORY, SHORT = 50_000, 64
#: Cells of an alignment that are kept for the way back; of larger ones every so many rows are kept and the rest computed anew.
CELLS = 1 << 22

_SPACE = b" \t\n\x0b\x0c\r"
_FAR = 1 << 28
_NAMES = {b"u": b"user", b"a": b"assistant"}

_REPAIRED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired array<struct<role: binary, text: binary>>"
)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by crc32("conv_id:turn") % 20.

    0 drops a row (``gone``; it only names its conversation), 1 empties its
    text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the
    user's. Null role, text and, in the key, null conv_id or turn are one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), kind.alias("kind"))

    def where(k: int, then: Column, other: str) -> Column:
        return F.when(F.col("kind") == k, then).otherwise(F.col(other))

    rows = rows.withColumn("text", where(1, F.lit(""), "text")).withColumn("text", where(2, F.translate("text", ".!?", ""), "text"))
    rows = rows.withColumn("role", where(4, F.lit("user"), "role")).withColumn("gone", F.col("kind") == 0)
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.withColumn("copy", F.explode(times)).select("conv_id", "turn", "role", "text", "gone")


class _Alignment:
    """Wagner-Fischer costs of a conversation's turns against all suffixes of ``uaua...ua``, inside a band.

    ``cost[i][r]`` aligns the turns from i on with the last r letters of the
    target, which are the same whatever its length, so one matrix serves every
    target length. Row i keeps the cells with r - (n - i) in [-below, above]:
    outside them insertions or deletions alone cost more than the incumbent.
    ``lead[i][r]`` is the same for a system turn, still to come, before r letters.
    """

    def __init__(self, initials: bytes, forced: np.ndarray, cut: np.ndarray):
        self.n, self.initials, self.forced, self.extra = len(initials), initials, forced, cut * TRUNCATED
        bound = self._incumbent()
        self.below, above = bound // DELETE + 1, bound // INSERT
        self.width = self.below + above + 1
        self.climb = INSERT * np.arange(self.width, dtype=np.int64)
        self.step = max(1, self.n if self.n * self.width <= CELLS else isqrt(self.n))
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        end = np.where(self._left(self.n) >= 0, INSERT * self._left(self.n), _FAR)
        pair = self.kept[self.n] = (end, np.full(self.width, _FAR, np.int64))
        self.block: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in range(self.n - 1, -1, -1):
            pair = self._row(i, *pair)
            if self.step >= self.n:
                self.block[i] = pair
            elif i % self.step == 0:
                self.kept[i] = pair
        self.first = pair

    def _incumbent(self) -> int:
        """The cost of one legal repair: turns take the next role in order, a system turn stays at the start only."""
        cost, expect = 0, b""
        for i in np.flatnonzero(~self.forced):
            initial = self.initials[i : i + 1]
            cost += int(self.extra[i])
            if not expect and initial == b"s":
                expect = b"s"
                continue
            wanted = b"a" if expect == b"u" else b"u"
            cost += REROLE * (initial != wanted)
            expect = wanted
        cost += DELETE * int(self.forced.sum()) + {b"s": 2 * INSERT, b"u": INSERT}.get(expect, 0)
        return min(cost, DELETE * self.n)

    def _left(self, i: int) -> np.ndarray:
        """Letters still to come (r) of each cell of row i; negative outside the matrix."""
        return np.arange(self.width) + (self.n - i - self.below)

    def _match(self, i: int) -> tuple[int, int]:
        """What it costs turn i to be the u and the a."""
        if self.forced[i]:
            return _FAR, _FAR
        initial = self.initials[i : i + 1]
        return tuple(int(self.extra[i]) + (0 if initial == x else REROLE) for x in (b"u", b"a"))

    def _row(self, i: int, below: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = self._left(i)
        as_u, as_a = self._match(i)
        deleted = np.append(below[1:], _FAR) + DELETE
        matched = np.where(left > 0, below + np.where(left % 2 == 0, as_u, as_a), _FAR)
        best = np.where(left >= 0, np.minimum(deleted, matched), _FAR)
        row = np.minimum(np.minimum.accumulate(best - self.climb) + self.climb, _FAR)
        row[left < 0] = _FAR
        started = np.append(lead[1:], _FAR) + DELETE
        if self.initials[i : i + 1] == b"s" and not self.forced[i]:
            begun = np.append(np.where((left >= 2) & (left % 2 == 0), 0, _FAR)[:-1] + below[1:], _FAR) + int(self.extra[i])
            started = np.minimum(started, begun)
        return row, np.minimum(started, _FAR)

    def rows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Row i, from the rows kept or computed anew together with its block."""
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            self.block = {}
            j = min(self.n, (i // self.step + 1) * self.step)
            pair = self.kept[j]
            for j in range(j - 1, i // self.step * self.step, -1):
                pair = self.block[j] = self._row(j, *pair)
        return self.block[i]

    def cheapest(self) -> tuple[int, str]:
        """The least cost, and the ASCII-least audit of all target lengths that have it.

        The audits of all these lengths are traced side by side: the least
        letter that any of them can give next stays, and those that give it.
        """
        plain, lead = self.first
        left = self._left(0)
        plain = np.where((left >= 0) & (left % 2 == 0), plain, _FAR)
        cost = int(min(plain.min(), lead.min()))
        live, waiting = plain == cost, lead == cost
        audit, i, none = [], 0, np.array([False])
        (now, now_lead), after = self.first, self.rows(1) if self.n else None
        while i < self.n or not live[self.below - (self.n - i)]:
            if i < self.n:
                below, below_lead = after
                go = live[:-1] & (now[:-1] == below[1:] + DELETE)
                go_lead = waiting[:-1] & (now_lead[:-1] == below_lead[1:] + DELETE)
                if go.any() or go_lead.any():
                    live, waiting = np.append(none, go), np.append(none, go_lead)
                    audit.append("D")
                    i, now, now_lead, after = i + 1, below, below_lead, self.rows(i + 2) if i + 2 <= self.n else None
                    continue
            go = live[1:] & (now[1:] == now[:-1] + INSERT)
            if go.any():
                live, waiting = np.append(go, none), np.zeros(self.width, bool)
                audit.append("I")
                continue
            left = self._left(i)
            initial, extra = self.initials[i : i + 1], int(self.extra[i])
            same = (left % 2 == 0) if initial == b"u" else (left % 2 == 1) if initial == b"a" else np.zeros(self.width, bool)
            open_ = live & (left > 0)
            kept = open_ & same & (now == below + extra)
            if initial == b"s":
                begun = waiting[:-1] & (now_lead[:-1] == below[1:] + extra)
                kept = kept | np.append(none, begun)
            if kept.any():
                live = kept
                audit.append("K")
            else:
                live = open_ & (now == below + extra + REROLE)
                audit.append("R")
            waiting = np.zeros(self.width, bool)
            i, now, now_lead, after = i + 1, below, below_lead, self.rows(i + 2) if i + 2 <= self.n else None
        return cost, "".join(audit)


def align(initials: bytes, forced: np.ndarray, cut: np.ndarray) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits that make the role initials ``(s?(ua)+)?``; of equal ones the ASCII-least audit.

    ``forced`` turns must be deleted, ``cut`` ones cost more if they stay. Time
    and, for short conversations, memory are turns times the width of the band,
    which the cost bounds; long ones keep the square root of their rows.
    """
    return _Alignment(initials, forced, cut).cheapest() if initials else (0, "")


def edited(turns: list[tuple[bytes, bytes]], audit: str) -> list[dict]:
    """The turns (role, text) after the edits of an audit."""
    out, i, expect = [], 0, b"u"
    for letter in audit:
        role, text = (b"", b"") if letter == "I" else turns[i]
        i += letter != "I"
        if letter == "D":
            continue
        out.append({"role": role if letter == "K" else _NAMES[expect], "text": text})
        expect = b"u" if letter == "K" and role[:1] == b"s" or expect == b"a" else b"a"
    return out


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.seen, self.numbers = conv_id, [], set(), set()
        self.faults = bytearray()

    def add(self, turn: int | None, role: bytes, text: bytes) -> None:
        shown = text.rstrip(_SPACE)
        if not shown:
            fault = b"b"
        elif (role, text) in self.seen:
            fault = b"d"
        else:
            fault = b"." if shown[-1:] in b".!?" else b"t"
        self.faults += fault
        self.seen.add((role, text))
        self.turns.append((role, text))
        if turn is not None:
            self.numbers.add(turn)

    def row(self, memory: dict) -> tuple:
        initials, faults = b"".join(role[:1] or b" " for role, _ in self.turns), bytes(self.faults)
        found = memory.get((initials, faults))
        if found is None:
            kinds = np.frombuffer(faults, np.uint8)
            found = align(initials, (kinds == ord("b")) | (kinds == ord("d")), kinds == ord("t"))
            if len(initials) <= SHORT:
                if len(memory) >= MEMORY:
                    memory.clear()
                memory[initials, faults] = found
        illegal = sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))
        gaps = max(self.numbers) - min(self.numbers) + 1 - len(self.numbers) if self.numbers else 0
        return (self.conv_id, gaps, *(faults.count(x) for x in (b"b", b"d", b"t")), illegal, *found, edited(self.turns, found[1]))


def _repairs(schema: pa.Schema, batch_turns: int = 20_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        rows, size, open_ = [], 0, None

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for conv, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")), strict=True):
                if open_ is None or conv != open_.conv_id:
                    if open_ is not None:
                        rows.append(open_.row(memory))
                        size += len(open_.turns)
                        if size > batch_turns:
                            yield full()
                            rows, size = [], 0
                    open_ = _Conversation(conv)
                if not gone:
                    open_.add(turn, role, text)
        if open_ is not None:
            rows.append(open_.row(memory))
        if rows:
            yield full()

    return run


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and the cheapest edits that give it a legal structure.

    ``turns`` has conv_id, turn, role, text and may have ``gone`` (boolean: the
    row only names its conversation). Returns conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit and ``repaired``, the turns after the edits
    as array<struct<role, text>>.

    A conversation's rows are taken by turn (nulls first), then role, then
    text, and aligned by :func:`align`. A conversation is one row of the
    result, audit and all, so one task holds it, as it holds a text; tasks
    stream sorted conversations and hold one at a time.

    Null conv_id: these rows are one conversation, named null. Null role or
    text: one space. Null turn: first, in no gap. Empty text is blank. Equal
    rows: all but the first are duplicates (blank ones are blank). Empty table:
    empty result. Other columns are left out.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).cast("binary").alias(c) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role, text, gone.alias("gone"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    struct = pa.struct([("role", pa.binary()), ("text", pa.binary())])
    longs = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([*((c, pa.int64()) for c in longs), ("audit", pa.string()), ("repaired", pa.list_(struct))])
    found = rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repairs(schema), _REPAIRED)
    return found.withColumn("repaired", F.col("repaired").cast("array<struct<role: string, text: string>>"))
