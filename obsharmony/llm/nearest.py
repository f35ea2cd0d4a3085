"""Nearest neighbours by vantage-point trees, one tree per shard of the vectors.

Every vector is in one shard's tree. A shard is one task: its vectors come first and become
its tree, then all queries stream past it in blocks; each tree's nearest are merged per query.
The triangle inequality prunes a subtree that lies further away than `factor` times the radius
found so far; factor one is exact search, smaller ones prune more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Trees:
    """Vectors per shard and per leaf, queries per block, and the factor of the pruning radius.

    Every query goes to every shard. So that its copies stay few, shards beyond `spread` are not
    added: they grow, up to `numbers` vector components each, and only then become more.
    """

    shard_rows: int = 8192
    leaf: int = 64
    block: int = 2048
    factor: float = 0.9
    seed: int = 5
    spread: int = 64
    numbers: int = 1 << 22

    def shards(self, rows: int, length: int) -> int:
        largest = max(self.shard_rows, self.numbers // max(1, length))
        return max(math.ceil(rows / largest), min(math.ceil(rows / self.shard_rows), self.spread))


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows that take part: an id, and a vector whose components are all finite and not all zero."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.where(F.col(key).isNotNull() & good).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of each row of q to each row of x, from the differences."""
    out = np.empty((len(q), len(x)))
    step = max(1, (1 << 20) // max(1, x.size))
    for i in range(0, len(q), step):
        d = q[i : i + step, None, :] - x[None]
        out[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def pair_distances(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows i of q to rows j of x, pair by pair, from the differences."""
    out = np.empty(len(i))
    step = max(1, (1 << 20) // max(1, x.shape[1]))
    for at in range(0, len(i), step):
        d = q[i[at : at + step]] - x[j[at : at + step]]
        out[at : at + step] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


class Tree:
    """Vantage-point tree over rows `x` with ids; nodes split at the median distance."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.leaf = ids[order], x[order], leaf
        self.rng = np.random.default_rng(seed)
        self.root = self.build(np.arange(len(ids)))
        del self.rng

    def build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        point = int(self.rng.choice(rows))
        d = distances(self.x[[point]], self.x[rows])[0]
        middle = float(np.median(d))
        inside = d <= middle
        if inside.all():  # at most half lie further out, so all are as far or nearer: split off the strictly nearer
            inside = d < middle
            if not inside.any():
                return rows
        return point, float(d[inside].max()), float(d[~inside].min()), self.build(rows[inside]), self.build(rows[~inside])


def search_tree(tree_ids: np.ndarray, x: np.ndarray, root, q: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and distances of the k nearest found for each query, without its own row.

    Every query first goes down to the leaf of its place, which gives it a radius; then all queries
    pass the tree together, so that a node is met once by those that it may hold something for.
    """
    n = len(q)
    found_d, found_id = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max)
    home = np.empty(n, np.int64)
    qq, xx = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", x, x)
    rounding = 8 * (x.shape[1] + 8) * np.finfo(float).eps

    def measure(rows: np.ndarray, who: np.ndarray) -> None:
        # Products tell, but for rounding, who can have a nearer row here; those pairs are measured from the differences.
        size = qq[who, None] + xx[rows]
        with np.errstate(over="ignore", invalid="ignore"):  # beyond the range of squares every pair is measured
            low = size * (1 - rounding) - 2 * (q[who] @ x[rows].T)
            far = (low > found_d[who, k - 1, None] ** 2) & (low < np.inf)
        i, j = np.nonzero(~far & (tree_ids[rows] != own[who, None]))
        if not len(i):
            return
        d = np.full(far.shape, np.inf)
        d[i, j] = pair_distances(q, x, who[i], rows[j])
        some = np.unique(i)
        who, d = who[some], d[some]
        ids = np.broadcast_to(tree_ids[rows], d.shape)
        d, ids = np.concatenate([found_d[who], d], 1), np.concatenate([found_id[who], ids], 1)
        best = np.lexsort((ids, d), axis=1)[:, :k]
        found_d[who], found_id[who] = np.take_along_axis(d, best, 1), np.take_along_axis(ids, best, 1)

    def visit(node, who: np.ndarray, first: bool) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            if first:
                home[who] = node[0]
            else:
                who = who[home[who] != node[0]]
            if len(who):
                measure(node, who)
            return
        point, most, least, inner, outer = node
        d = distances(q[who], x[[point]])[:, 0]
        near = d <= (most + least) / 2
        for side, here, gap in ((inner, near, d - most), (outer, ~near, least - d)):
            visit(side, who[here | (gap <= factor * found_d[who, k - 1])] if not first else who[here], first)

    for first in (True, False):
        visit(root, np.arange(n), first)
    return np.where(np.isinf(found_d), -1, found_id), found_d


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, p: Trees = Trees(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows, itself left out.

    Ties go to the smaller id. Rows of `queries` and `vectors` with missing, zero or non-finite
    vectors take no part. All vectors have one length. Repeated ids are candidates each;
    a repeated query is answered once. Empty tables give no rows.
    """
    rows, asked = usable(vectors, key, vector), usable(queries, key, vector).dropDuplicates(["id"])
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("length")).first()
    if not seen.n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = p.shards(seen.n, seen.length)
    placed = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(p.seed), "id", "v"), F.lit(shards)).cast("int"))
    # The queries of a shard come behind its vectors, one row each: a join could hand all of them, times the shards, to the driver.
    copies = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = placed.withColumn("asks", F.lit(False)).unionByName(copies.withColumn("asks", F.lit(True)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            numbers, asks = batch["shard"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False)
            ids, x = batch["id"].to_numpy(), batch["v"].flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)
            # Rows come by shard, vectors before queries: cut where either changes, and in blocks.
            ends = np.flatnonzero((numbers[1:] != numbers[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, z in zip([0, *ends], [*ends, batch.num_rows]):
                if numbers[a] != shard:
                    shard, held, tree = numbers[a], [], None
                if not asks[a]:
                    held.append((ids[a:z], x[a:z]))
                    continue
                if tree is None and held:
                    tree = Tree(*(np.concatenate(part) for part in zip(*held)), p.leaf, p.seed)
                    held = []
                for b in range(a, z if tree else a, p.block):
                    own = ids[b : min(b + p.block, z)]
                    found, d = search_tree(tree.ids, tree.x, tree.root, x[b : b + len(own)], own, k, p.factor)
                    there = (d < np.inf).ravel()
                    columns = (np.repeat(own, k)[there], found.ravel()[there], d.ravel()[there])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    # A shard is a partition of its own.
    met = met.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "asks", "id")
    pairs = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
