"""Product codes of vectors: integer k-means per part, with few exact distances.

Every vector is cut into equal parts, and each part position has a codebook of its own. Between
rounds each part keeps its b closest entries with ordered lower bounds of their distances, an
upper bound for the nearest, and one outer bound for all entries that it does not keep. When
the codebook moves, the bounds move with it; only where they overlap are distances computed,
in integers, so the codes are those of a full search. b shrinks to what the last round needed.

Spark holds the vectors and their bounds as a table, written once a round; codebooks (parts x
entries) and their sums are of fixed size and pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored

#: Integer components beyond this size count as this size, so that sums of squares fit 64 bits.
LARGEST = 1 << 27
_STATE = "q array<int>, near binary, bounds binary, part int, entry int, n long, sums array<long>"


@dataclass(frozen=True)
class Coding:
    """Codebook shape, rounds, and how the number of kept entries shrinks."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    #: Kept entries: half of the codebook at first, an eighth at least.
    first_kept: int = 8
    least_kept: int = 2
    #: Share of parts that the kept entries of the next round should settle.
    settled: float = 0.995


@dataclass
class Codebooks:
    """Entries per part position, [parts][entries, width], and how each round settled its parts."""

    books: list[np.ndarray]
    kept: list[int] = field(default_factory=list)
    #: Per round: settled by bounds, after one exact distance, among the kept entries, by all entries.
    looks: list[list[int]] = field(default_factory=list)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def integral(vectors: DataFrame, vector: str, scale: int, *keep: str) -> DataFrame:
    """Rows whose vector has only finite components, as `q`: floor(scale * x) per component."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    whole = lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    return vectors.where(x.isNotNull() & ~bad).select(*keep, F.transform(x, whole).alias("q"))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; entries is [k, width], or [n, k, width] with a choice per point."""
    d = points[:, None, :] - entries
    return np.einsum("nkd,nkd->nk", d, d)


def _ordered(bounds: np.ndarray) -> np.ndarray:
    """Lower bounds (from column 1) cut down to those on their right."""
    bounds[:, 1:] = np.minimum.accumulate(bounds[:, :0:-1], axis=1)[:, ::-1]
    return bounds


def _all_entries(points: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    squares = _squares(points, book)
    order = np.argsort(squares, axis=1, kind="stable")  # ties to the lower index
    far = np.sqrt(np.take_along_axis(squares, order, 1)[:, : b + 1].astype(np.float64))
    bounds = np.full((len(points), b + 1), np.inf, np.float32)
    bounds[:, 0] = _up(far[:, 0])
    bounds[:, 1 : far.shape[1]] = _down(far[:, 1:])
    return order[:, :b].astype(np.uint8), bounds


def nearest_entries(
    points: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray | None, bounds: np.ndarray | None, b: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept entries (nearest first), bounds (upper, ordered lower ones, outer) and what each point took.

    moved: by how much each entry moved since the bounds held, rounded up. The last result is 0
    where bounds settled a point, 1 after its exact distance, 1 + j where j + 1 kept entries
    were compared, b + 1 where all were."""
    n, b = len(points), min(b, len(book))
    if near is None:
        return *_all_entries(points, book, b), np.full(n, b + 1)
    near, bounds = near[:, :b].copy(), bounds[:, : b + 1].astype(np.float64)
    bounds[:, 0] += moved[near[:, 0]]
    bounds[:, 1:b] -= moved[near[:, 1:]]
    bounds[:, b] -= moved.max()
    _ordered(bounds)
    took = np.zeros(n, np.int64)
    open_ = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    if len(open_):
        took[open_] = 1
        bounds[open_, 0] = np.sqrt(_squares(points[open_], book[near[open_, :1]])[:, 0].astype(np.float64)) * (1 + 1e-12)
        clear = bounds[open_, :1] < bounds[open_, 1:]
        first = np.where(clear.any(1), clear.argmax(1), b)
        took[open_] += first
        for j in range(1, b):  # the nearest is one of the first j + 1 kept entries
            at = open_[first == j]
            if len(at):
                some = near[at, : j + 1]
                squares = _squares(points[at], book[some])
                order = np.lexsort((some, squares), axis=1)
                near[at, : j + 1] = np.take_along_axis(some, order, 1)
                far = np.sqrt(np.take_along_axis(squares, order, 1).astype(np.float64))
                bounds[at, 0] = far[:, 0] * (1 + 1e-12)
                bounds[at, 1 : j + 1] = far[:, 1:] * (1 - 1e-12)
    out = np.empty((n, b + 1), np.float32)
    out[:, 0], out[:, 1:] = _up(bounds[:, 0]), _down(_ordered(bounds)[:, 1:])
    at = open_[first == b] if len(open_) else open_
    if len(at):
        near[at], out[at] = _all_entries(points[at], book, b)
    return near, out, took


def _cuts(width: int, parts: int) -> list[int]:
    return [i * width // parts for i in range(parts + 1)]


def _bytes_column(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows).reshape(len(rows), -1).view(np.uint8)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _points(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, width)


def _moved_on(batch: pa.RecordBatch, points: np.ndarray, books: list, moves: list, before: int, b: int) -> list[tuple]:
    """Per part position what nearest_entries gives."""
    cuts, out = _cuts(points.shape[1], len(books)), []
    near = bounds = None
    if before:
        near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(len(points), len(books), before)
        bounds = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), np.float32).reshape(len(points), len(books), before + 1)
    for p, book in enumerate(books):
        own = (near[:, p], bounds[:, p]) if before else (None, None)
        out.append(nearest_entries(points[:, cuts[p] : cuts[p + 1]], book, moves[p], *own, b))
    return out


def _assigning(books: list[np.ndarray], moves: list[np.ndarray], before: int, b: int, width: int, keep: list[str]):
    """Assign one round: rows with new bounds, then per task the sums of each entry's parts and what was looked at."""
    parts, k = len(books), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(width, parts)
        sums = [np.zeros((k, cuts[p + 1] - cuts[p]), np.int64) for p in range(parts)]
        counts, took = np.zeros((parts, k), np.int64), np.zeros(max(b, 1) + 2, np.int64)
        schema = None
        for batch in batches:
            points = _points(batch, width)
            done = _moved_on(batch, points, books, moves, before, b)
            for p, (near, _, looks) in enumerate(done):
                np.add.at(sums[p], near[:, 0], points[:, cuts[p] : cuts[p + 1]])
                counts[p] += np.bincount(near[:, 0], minlength=k)
                took += np.bincount(looks, minlength=len(took))
            none = lambda kind: pa.nulls(batch.num_rows, kind)
            columns = [batch.column(c) for c in keep] + [
                batch.column("q"), _bytes_column(np.stack([d[0] for d in done], 1)), _bytes_column(np.stack([d[1] for d in done], 1)),
                none(pa.int32()), none(pa.int32()), none(pa.int64()), none(pa.list_(pa.int64())),
            ]
            names = [*keep, "q", "near", "bounds", "part", "entry", "n", "sums"]
            schema = pa.schema([(a, c.type) for a, c in zip(names, columns, strict=True)])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if schema is not None:
            rows = [(p, e, int(counts[p, e]), sums[p][e].tolist()) for p in range(parts) for e in np.flatnonzero(counts[p]).tolist()]
            rows += [(-1, j, int(x), []) for j, x in enumerate(took) if x]
            columns = [pa.nulls(len(rows), f.type) for f in list(schema)[: len(keep) + 3]]
            columns += [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(schema)[-4:])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _coding(books: list[np.ndarray], moves: list[np.ndarray], before: int, b: int, width: int, keep: list[str]):
    """The last assignment: codes and exact errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(width, len(books))
        for batch in batches:
            points = _points(batch, width)
            error, codes = np.zeros(len(points), np.int64), np.zeros((len(points), len(books)), np.uint8)
            for p, (near, _, _) in enumerate(_moved_on(batch, points, books, moves, before, b)):
                d = points[:, cuts[p] : cuts[p + 1]] - books[p][near[:, 0]]
                error += np.einsum("nd,nd->n", d, d)
                codes[:, p] = near[:, 0]
            columns = [*(batch.column(c) for c in keep), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "code", "error"])

    return run


def encode(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ("label",), settings: Coding | None = None
) -> tuple[DataFrame, Codebooks]:
    """Code and error (squared distance in integer units) of every vector, and the codebooks.

    The first entries are the parts of the vectors with the smallest ids (missing ids last, ties by
    components); with fewer vectors than entries the codebooks have as many entries as there are
    vectors. Ties of distance go to the lower index, unused entries stay, means are rounded down.
    Missing vectors and those with a missing or non-finite component take no part, nor do those
    of another length than the first; a length that is no multiple of the parts is cut at i * length // parts. Components beyond
    LARGEST count as LARGEST. Repeated rows count as often as they occur. An empty table gives an
    empty result and empty codebooks. Columns other than id, vector and keep are not read.
    """
    s = settings or Coding()
    spark, columns = vectors.sparkSession, [id, *keep]
    if s.entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    q = integral(vectors, vector, s.scale, *columns)
    first = [r.q for r in q.orderBy(F.col(id).asc_nulls_last(), "q").limit(1).collect()]
    kinds = ", ".join(f"`{c}` {q.schema[c].dataType.simpleString()}" for c in columns)
    result = f"{kinds}, code string, error long"
    if not first:
        return spark.createDataFrame([], result), Codebooks([np.zeros((0, 0), np.int64)] * s.parts)
    width = len(first[0])
    q = q.where(F.size("q") == width)
    seeds = np.array([r.q for r in q.orderBy(F.col(id).asc_nulls_last(), "q").limit(s.entries).collect()], np.int64).reshape(-1, width)
    cuts = _cuts(width, s.parts)
    found = Codebooks([seeds[:, cuts[p] : cuts[p + 1]] for p in range(s.parts)])
    moves, before, b, path, state = [np.zeros(len(seeds))] * s.parts, 0, min(s.first_kept, len(seeds)), None, q
    for _ in range(s.rounds):
        fresh = state.mapInArrow(_assigning(found.books, moves, before, b, width, columns), f"{kinds}, {_STATE}")
        old, (written, path) = path, stored(fresh, "codes")
        if old:
            forget(spark, old)
        totals = written.where(F.col("part").isNotNull()).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(max(np.diff(cuts), default=0)))
        )
        books, looks = [x.copy() for x in found.books], [0] * (b + 2)
        for r in totals.collect():  # parts x entries rows, and one for each number of looks
            if r.part < 0:
                looks[r.entry] = r.n
            else:
                wide = cuts[r.part + 1] - cuts[r.part]
                books[r.part][r.entry] = [r[f"s{i}"] // r.n for i in range(wide)]
        moves = [np.sqrt(np.square(x - y).sum(1).astype(np.float64)) * (1 + 1e-12) for x, y in zip(books, found.books, strict=True)]
        found.kept.append(b)
        found.looks.append([looks[0], looks[1], sum(looks[2:-1]), looks[-1]])
        before, found.books = b, books
        if found.looks[:-1]:  # the first round compares all entries
            share = np.cumsum(looks) / max(1, sum(looks))
            b = max(min(s.least_kept, b), min(b, int(np.argmax(share >= s.settled))))
        state = written.where(F.col("part").isNull()).select(*columns, "q", "near", "bounds")
    return state.mapInArrow(_coding(found.books, moves, before, b, width, columns), result), found
