"""Random forests grown from cells instead of rows.

A forest sees of a row only the bins of its inputs, 32 a column at most. Rows with equal bins meet
in a cell, and a cell's drawn rows and their sum, for each tree, are all that its trees need. So the
rows are read once, whatever the number of trees, levels and rounds; bags are drawn row by row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
#: Columns whose bins could make more cells than this are left to forests over rows.
MOST_CELLS = 1 << 18
#: Rows that a task counts at once.
_CHUNK = 1 << 19
#: Position of a row: what its bags are drawn by.
PLACE = "__place"


def cuts_of(rows: DataFrame, columns: Sequence[str]) -> dict[str, np.ndarray]:
    """Where the bins of each column part: between all its values if they are few, else at quantiles."""
    kinds = rows.agg(
        *[F.approx_count_distinct(c).alias(f"many_{c}") for c in columns],
        *[F.count_if(F.isnan(F.col(c).cast("double"))).alias(f"nan_{c}") for c in columns],
    ).first()
    if bad := [c for c in columns if kinds[f"nan_{c}"]]:
        raise ValueError(f"a forest takes no NaN: {bad}")
    cuts = {}
    for c in columns:
        if kinds[f"many_{c}"] <= 2 * BINS:
            found = rows.select(F.col(c).cast("double").alias("x")).dropna().distinct().limit(BINS + 1).collect()
            if len(found) <= BINS:
                x = np.sort(np.array([r.x for r in found], float))
                cuts[c] = x[:-1] / 2 + x[1:] / 2
    if rest := [c for c in columns if c not in cuts]:
        at = [i / BINS for i in range(1, BINS)]
        found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 2000).alias(c) for c in rest]).first()
        cuts |= {c: np.unique(np.array(found[c], float)) for c in rest}
    return {c: cuts[c] for c in columns}


class Space:
    """Codes of the columns' bins, a missing value being one bin more, and keys of cells."""

    def __init__(self, cuts: dict[str, np.ndarray], gaps: Sequence[str]):
        self.columns, self.cuts = list(cuts), list(cuts.values())
        self.gaps = [self.columns.index(c) for c in gaps]
        self.bins = [len(x) + 1 for x in self.cuts]
        self.steps = [math.prod(b + 1 for b in self.bins[:j]) for j in range(len(self.bins))]

    def most(self, labels: Sequence[int]) -> int:
        """Cells there can be: rows without a gap by the inputs of each label, rows with gaps by all columns."""
        full = math.prod(self.bins)
        return sum(full // self.bins[c] for c in labels) + math.prod(b + (j in self.gaps) for j, b in enumerate(self.bins)) - full

    def codes(self, values: Sequence[np.ndarray]) -> list[np.ndarray]:
        """A value is in the bin of the first cut that is not below it; NaN stands for a missing value."""
        return [np.where(np.isnan(x), b, np.searchsorted(cut, x)) for x, cut, b in zip(values, self.cuts, self.bins)]

    def keys(self, codes: Sequence[np.ndarray]) -> np.ndarray:
        return sum(c.astype(np.int64) * s for c, s in zip(codes, self.steps))

    def decoded(self, keys: np.ndarray) -> np.ndarray:
        """One row of codes for each key."""
        return np.stack([keys // s % (b + 1) for s, b in zip(self.steps, self.bins)], 1)


def _poisson() -> np.ndarray:
    """How often a row is drawn, mean one, for each 16-bit number."""
    below = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    return np.searchsorted(np.round(below * 65536), np.arange(65536), side="right").astype(np.uint8)


_DRAWN = _poisson()


def draws(places: np.ndarray, trees: int, label: int) -> np.ndarray:
    """How often each row is in the bag of each tree; places are hashes."""
    words = -(-trees // 4)
    x = places.astype(np.uint64)[:, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(label * words + 1, (label + 1) * words + 1, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):  # finalising mix of splitmix64 (public domain)
        x ^= x >> np.uint64(shift)
        if factor:
            x *= np.uint64(factor)
    return _DRAWN[x.view(np.uint16)[:, :trees]]


def placed(rows: DataFrame, seed: int) -> DataFrame:
    return rows.withColumn(PLACE, F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))


def _sums(keys: np.ndarray, columns: Iterator[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys, and the sums of each column by key."""
    found, at = np.unique(keys, return_inverse=True)
    return found, [np.bincount(at, c, len(found)) for c in columns]


def tallied(rows: DataFrame, columns: Sequence[str], tally, width: int) -> pa.Table:
    """label, key and `width` sums of each cell over all rows.

    `tally(column arrays by name)` yields label, keys and columns of the same length, of which the sums count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[pa.Table]:
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= _CHUNK:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
            if n:
                yield pa.Table.from_batches(held)

        for chunk in chunks():
            values = {c: chunk[c].to_numpy() for c in chunk.column_names}
            for label, keys, added in tally(values):
                if len(keys):
                    found, sums = _sums(keys, added)
                    named = {"label": np.full(len(found), label, np.int32), "key": found} | {f"s{i}": s for i, s in enumerate(sums)}
                    yield pa.RecordBatch.from_pydict(named)

    names = [f"s{i}" for i in range(width)]
    parts = rows.select(*columns).mapInArrow(count, "label int, key long, " + ", ".join(f"{s} double" for s in names))
    return parts.groupBy("label", "key").agg(*[F.sum(s).alias(s) for s in names]).toArrow()


def cells_of(table: pa.Table, label: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a label's cells, in order, and their sums."""
    mine = np.flatnonzero(table["label"].to_numpy() == label)
    mine = mine[np.argsort(table["key"].to_numpy()[mine], kind="stable")]
    sums = np.stack([table[c].to_numpy()[mine] for c in table.column_names[2:]], 1)
    return table["key"].to_numpy()[mine], sums


class CellForest(RandomForestRegressor):
    """Spark's forest by its parameters and defaults (a third of the inputs at a node, variance as
    impurity, one row a leaf at least), fitted to cells: (codes of the inputs, bins of each, drawn rows
    and their sums by tree)."""

    def _fit(self, cells):
        codes, bins, drawn, sums = cells
        depth, seed = self.getMaxDepth(), self.getSeed()
        trees = [_grown(codes, bins, drawn[:, t], sums[:, t], depth, np.random.default_rng([seed, t])) for t in range(self.getNumTrees())]
        return Forest(trees, depth)


class Forest:
    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int):
        self.trees, self.depth = trees, depth

    def predict(self, codes: np.ndarray) -> np.ndarray:
        """Mean of the trees' values for each row of codes."""
        total = np.zeros(len(codes))
        for inputs, cut, value in self.trees:
            node = np.zeros(len(codes), np.int64)
            for _ in range(self.depth):
                split = inputs[node]
                right = codes[np.arange(len(codes)), np.maximum(split, 0)] > cut[node]
                node = np.where(split < 0, node, 2 * node + 1 + right)
            total += value[node]
        return total / max(1, len(self.trees))


def _grown(codes: np.ndarray, bins: Sequence[int], drawn: np.ndarray, sums: np.ndarray, depth: int, rng: np.random.Generator):
    """Input, last bin to the left, and value of each node; the children of node i are 2 i + 1 and 2 i + 2."""
    size = 2 ** (depth + 1) - 1
    inputs, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
    live = drawn > 0
    codes, drawn, sums, node = codes[live], drawn[live], sums[live], np.zeros(int(live.sum()), np.int64)
    if not len(node):
        return inputs, cut, value
    third = -(-codes.shape[1] // 3)
    for level in range(depth + 1):
        width, first = 2**level, 2**level - 1
        n, total = np.bincount(node, drawn, width), np.bincount(node, sums, width)
        there = n > 0
        value[first : first + width] = np.divide(total, n, out=np.zeros(width), where=there)
        if level == depth or not codes.shape[1]:
            break
        tried = rng.random((width, codes.shape[1])).argsort(1).argsort(1) < third
        own = np.divide(total**2, n, out=np.zeros(width), where=there)
        best = own * (1 + 1e-12)
        for j, b in enumerate(bins):
            at = node * b + codes[:, j]
            left = np.bincount(at, drawn, width * b).reshape(width, b).cumsum(1)[:, :-1]
            left_sum = np.bincount(at, sums, width * b).reshape(width, b).cumsum(1)[:, :-1]
            right, right_sum = n[:, None] - left, total[:, None] - left_sum
            both = (left > 0.5) & (right > 0.5) & tried[:, [j]]
            gain = np.full(left.shape, -np.inf)
            np.divide(left_sum**2, left, out=gain, where=both)
            gain += np.divide(right_sum**2, right, out=np.zeros(left.shape), where=both)
            if b > 1:
                where = gain.argmax(1)
                gain = gain[np.arange(width), where]
                better = gain > best
                best[better] = gain[better]
                inputs[first : first + width][better], cut[first : first + width][better] = j, where[better]
        split = inputs[first : first + width][node]
        on = split >= 0
        codes, drawn, sums, node, split = codes[on], drawn[on], sums[on], node[on], split[on]
        right = codes[np.arange(len(node)), split] > cut[first + node]
        node = 2 * node + right
        if not len(node):
            break
    return inputs, cut, value
