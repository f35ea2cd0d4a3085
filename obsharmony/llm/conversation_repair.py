"""Repair of a conversation's structure: the cheapest edits to turns in an allowed order.

A repaired conversation is empty, or a system turn (optional) and then user and assistant turns
in pairs. Rows are first reduced to symbols (role and fault), and equal symbols in a row to runs.
A symbol is a min-plus transition between the places of the allowed order; a run of n equal
symbols is the n-th power of it, put together from cached powers of two. Edits are then read
off run by run, by halving, so that a run costs its length only in the audit text itself.

Spark sorts slim rows (symbols and digests, no text) by conversation and turn for this, and the
texts a second time to hash what is left; both passes stream, so no conversation is held in
memory but for some bytes per run and per letter of its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK, DUPLICATE, TRUNCATED, SOUND = 0, 1, 2, 3
_INF = 1 << 60
#: Places: nothing yet, after the system turn, after a user turn, after an assistant turn.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_PLACES = range(4)
_DONE = (0, 3)
#: Pairs of role initials that may follow each other.
LEGAL = ("su", "ua", "au")
_INSERTED = {2: "user", 3: "assistant"}  # the role that leads to a place


@dataclass(frozen=True)
class Costs:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


Matrix = tuple[tuple[int, ...], ...]
#: A symbol: role initial, or "" for one that no place takes, and whether it is truncated; None: must go.
Symbol = tuple[str, bool] | None


def _times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(x + y[j] for x, y in zip(row, b, strict=True)) for j in _PLACES) for row in a)


def _on(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in a)


class Repairer:
    """The edits for sequences of symbols under given costs; remembers powers and runs."""

    def __init__(self, costs: Costs):
        self.costs = costs
        one = {(q, r) for (q, _), r in _STEP.items() if r in _INSERTED}
        step = tuple(tuple(0 if q == r else costs.insert if (q, r) in one else _INF for r in _PLACES) for q in _PLACES)
        self.inserts = _times(_times(step, step), step)  # more in a row come back to a place
        self.end = _on(self.inserts, tuple(0 if q in _DONE else _INF for q in _PLACES))
        self.power = lru_cache(None)(self._power)
        self.run = lru_cache(1 << 14)(self._run)
        self.short = lru_cache(1 << 14)(self._short)

    def choices(self, symbol: Symbol, q: int) -> Iterator[tuple[str, int, int]]:
        """Edits of one row at a place, without inserts: initial, cost, next place."""
        yield "D", self.costs.delete, q
        if symbol is None:
            return
        role, cut = symbol
        more = self.costs.truncated * cut
        if (q, role) in _STEP:
            yield "K", more, _STEP[q, role]
        yield "R", self.costs.rerole + more, 3 if q == 2 else 2

    def _power(self, symbol: Symbol, k: int) -> Matrix:
        """Transition of 2^k equal symbols, inserts before each included."""
        if k:
            half = self.power(symbol, k - 1)
            return _times(half, half)
        row = [[_INF] * 4 for _ in _PLACES]
        for q in _PLACES:
            for _, cost, r in self.choices(symbol, q):
                row[q][r] = min(row[q][r], cost)
        return _times(self.inserts, tuple(map(tuple, row)))

    def back(self, symbol: Symbol, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
        """Costs to the end before n equal symbols, from those after them."""
        k = 0
        while n >> k:
            if n >> k & 1:
                after = _on(self.power(symbol, k), after)
            k += 1
        return after

    def _run(self, symbol: Symbol, n: int, after: tuple[int, ...], q: int) -> tuple[str, int]:
        """Least cheapest edits of a run from place q, and the place after it.

        after: costs to the end behind the run, less their minimum."""
        if n > 1:
            left, at = self.run(symbol, n // 2, _level(self.back(symbol, n - n // 2, after)), q)
            right, at = self.run(symbol, n - n // 2, after, at)
            return left + right, at
        out, aim = "", self.back(symbol, 1, after)[q]
        while True:
            best = min(((e, cost, r) for e, cost, r in self.choices(symbol, q) if cost + after[r] == aim), default=None)
            after_insert = self._insert(q, aim, lambda r: self.back(symbol, 1, after)[r])
            if best is not None and (after_insert is None or best[0] < "I"):
                return out + best[0], best[2]
            assert after_insert is not None
            out, q, aim = out + "I", after_insert, aim - self.costs.insert

    def _insert(self, q: int, aim: int, rest) -> int | None:
        """The place after an insert that keeps to the least cost, if there is one."""
        return next((r for (p, _), r in _STEP.items() if p == q and r in _INSERTED and self.costs.insert + rest(r) == aim), None)

    def audit(self, runs: list[tuple[Symbol, int]]) -> tuple[str, int]:
        """Least cheapest edits of a conversation, and their cost; long ones are not remembered."""
        return self.short(tuple(runs)) if len(runs) < 64 else self._short(runs)

    def _short(self, runs: Iterable[tuple[Symbol, int]]) -> tuple[str, int]:
        after, behind = [_level(self.end)], min(self.end)
        for symbol, n in reversed(list(runs)):
            costs = self.back(symbol, n, after[-1])
            behind += min(costs)
            after.append(_level(costs))
        cost, q, out = behind + after[-1][0], 0, []
        for (symbol, n), rest in zip(runs, after[-2::-1], strict=True):
            edits, q = self.run(symbol, n, rest, q)
            out.append(edits)
        aim = self.end[q]
        while q not in _DONE:
            q, aim = self._insert(q, aim, lambda r: self.end[r]), aim - self.costs.insert
            out.append("I")
        return "".join(out), cost


def _level(v: tuple[int, ...]) -> tuple[int, ...]:
    least = min(v)
    return tuple(min(x - least, _INF) for x in v)


def repaired_roles(audit: str, roles: Iterable[str]) -> Iterator[tuple[str, int | None]]:
    """What the edits leave: role and, unless inserted, the row's number."""
    q, rows = 0, enumerate(roles)
    for edit in audit:
        if edit == "I":
            q = 3 if q == 2 else 2
            yield _INSERTED[q], None
            continue
        i, role = next(rows)
        if edit == "K":
            q = _STEP[q, role[:1]]
            yield role, i
        elif edit == "R":
            q = 3 if q == 2 else 2
            yield _INSERTED[q], i


def faults(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character that is none of space, tab to return ends no sentence."""
    return ~text.rlike(r"[^\x20\x09-\x0D]"), ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return conversations.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"), blank(role).alias("_role"), blank(text).alias("_text")
    )


def _digest() -> Column:
    return F.unhex(F.md5(F.encode(F.concat(F.octet_length("_role").cast("string"), F.lit(":"), "_role", "_text"), "UTF-8")))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Rows of sorted batches by their first column."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda r: r[0])


def _measuring(costs: Costs):
    """Per conversation: gaps, fault counts, illegal pairs, cost and audit, from its symbols in order."""

    def measured(rows: Iterator[tuple], repairer: Repairer) -> tuple:
        counts, runs, pairs = [0, 0, 0, 0], [], 0
        low = high = last = before = None
        turns = 0
        for _, turn, digest, initial, blank, cut, n, first in rows:
            if digest is None:
                continue  # tells only that the conversation exists
            if turn is not None:
                turns += turn != last
                low, high, last = turn if low is None else low, turn, turn
            role = initial if (initial in ("s", "u", "a")) else ""
            sound: Symbol = (role, cut)
            for symbol, k in [(None, n)] if blank or not first else [(sound, 1), (None, n - 1)]:
                if not k:
                    continue
                kind = BLANK if blank else DUPLICATE if symbol is None else TRUNCATED if cut else SOUND
                counts[kind] += k
                if runs and runs[-1][0] == symbol:
                    runs[-1] = (symbol, runs[-1][1] + k)
                else:
                    runs.append((symbol, k))
            pairs += before is not None and before + initial not in LEGAL
            pairs += n - 1 if initial + initial not in LEGAL else 0
            before = initial
        audit, cost = repairer.audit(runs)
        gaps = min(high - low + 1 - turns, (1 << 63) - 1) if turns else 0
        return (gaps, *counts[:3], pairs, cost, audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, out = Repairer(costs), []
        for conv, rows in _conversations(batches):
            out.append((conv, *measured(rows, repairer)))
            if len(out) >= 4096:
                yield _table(out)
                out = []
        if out:
            yield _table(out)

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        conv, *numbers, audit = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers), pa.array(audit, pa.string())],
            names=["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        )

    return run


_MEASURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def measure(rows: DataFrame, present: DataFrame, costs: Costs) -> DataFrame:
    """Measures and audit of each conversation in `present`; rows as _rows gives them.

    Rows alike in all columns are counted before the sort, and a text's first turn is found by an
    aggregate and sorted in beside the rows, so neither a hot row nor a hot text is gathered."""
    blank, cut = faults(F.col("_text"))
    slim = rows.select("_conv", "_turn", "_role", _digest().alias("digest"), F.substring("_role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut"))
    counted = slim.groupBy("_conv", "_turn", "_role", "digest").agg(F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.count("*").alias("n"))
    # A missing turn sorts first, so it is the first one of its text.
    firsts = counted.groupBy("_conv", "_role", "digest").agg(F.min(F.struct(F.col("_turn").isNotNull().alias("known"), "_turn")).alias("at"))
    marks = firsts.select("_conv", F.col("at._turn").alias("_turn"), "_role", "digest", F.lit(None).cast("long").alias("n"), F.lit(True).alias("first"))
    both = counted.withColumn("first", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    told = both.groupBy("_conv", "_turn", "_role", "digest").agg(
        F.max("initial").alias("initial"), F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.max("n").alias("n"), F.max("first").alias("first")
    )
    every = told.unionByName(present.select("_conv"), allowMissingColumns=True)
    order = [F.col("_conv"), F.col("_turn").asc_nulls_first(), "_role", "digest"]
    columns = ["_conv", "_turn", "digest", "initial", "blank", "cut", "n", "first"]
    placed = every.repartition("_conv").sortWithinPartitions(*order).select(*columns)
    return placed.mapInArrow(_measuring(costs), f"_conv long, {_MEASURES}")


def _hashing():
    """SHA-256 of what each conversation's audit leaves; the audit stands before the rows."""

    def hashed(rows: Iterator[tuple]) -> tuple:
        _, *measures, _, _ = next(rows)
        h, sep = hashlib.sha256(), b""
        texts, role = [], []

        def roles() -> Iterator[str]:
            for r in rows:
                texts[:] = [r[-1]]
                yield r[-2]

        for role, i in repaired_roles(measures[-1], roles()):
            h.update(sep + f"{role}:{texts[0] if i is not None else ''}".encode())
            sep = b"\n"
        return (*measures, h.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in _conversations(batches):
            out.append((conv, *hashed(rows)))
            if len(out) >= 1024:
                yield _table(out)
                out = []
        if out:
            yield _table(out)

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        conv, *numbers, audit, sha = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers), pa.array(audit, pa.string()), pa.array(sha, pa.string())],
            names=["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
        )

    return run


def _edited():
    """Rows (and measures as they are) to the repaired turns of each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in _conversations(batches):
            audit, held = next(rows)[-3], []

            def roles() -> Iterator[str]:
                for r in rows:  # noqa: B023
                    held[:] = [r[-1]]  # noqa: B023
                    yield r[-2]

            for k, (role, i) in enumerate(repaired_roles(audit, roles())):
                out.append((conv, k, role, held[0] if i is not None else ""))
                if len(out) >= 1024:
                    yield _table(out)
                    out = []
        if out:
            yield _table(out)

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        conv, k, role, text = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(k, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string())], names=["conv_id", "turn", "role", "text"])

    return run


def _beside(measures: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's measures and then its rows in order, in one task each, streamed."""
    both = measures.withColumn("_row", F.lit(False)).unionByName(rows.withColumn("_row", F.lit(True)).withColumn("digest", _digest()), allowMissingColumns=True)
    names = [x.split()[0] for x in _MEASURES.split(", ")]
    placed = both.repartition("_conv").sortWithinPartitions("_conv", "_row", F.col("_turn").asc_nulls_first(), "_role", "digest")
    return placed.select("_conv", *names, "_role", "_text")


def repair(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    costs: Costs | None = None, present: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per conversation its measures, audit and the digest of what is left; and the repaired turns.

    Rows go by turn, missing turns first, ties by role and then by a digest of the row. A missing
    role or text is one space; missing conversation ids form one conversation. Rows that are
    blank or repeat the role and text of an earlier row of the conversation must go. `present` may name
    conversations (by the same column) that have no rows left: their measures are zero, the audit
    is empty, and the digest is that of nothing. Other columns are not read. An empty table
    gives empty results. Conversation ids are longs.
    """
    rows = _rows(conversations, conv, turn, role, text)
    there = (conversations if present is None else present).select(F.col(conv).alias("_conv")).distinct()
    measures = measure(rows, there, costs or Costs())
    beside = _beside(measures, rows)
    told = beside.mapInArrow(_hashing(), f"_conv long, {_MEASURES}, repaired_sha256 string").withColumnRenamed("_conv", conv)
    return told, beside.mapInArrow(_edited(), "conv_id long, turn long, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Planted faults by crc32 of conversation and turn, modulo 20: a row dropped (0), emptied (1),
    without its sentence ends (2), there twice (3), or said by the user (4). Nulls are one space."""
    c = conversations
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("_code") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = c.select("conv_id", "turn", "role", "text", code.alias("_code")).where("_code <> 0")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")
