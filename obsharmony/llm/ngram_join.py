"""Similarity join of documents on word n-grams, by vertical partitioning.

N-grams are put in one global order: by the number of different texts that have them, then
by hash. Candidates are documents that share an n-gram of their prefixes (the rarest
n - ceil(t n) + 1 of each); two that reach the similarity t always do. The order is cut into
fragments by octaves of that number; a pair's overlap is counted in each fragment apart and
summed per pair. N-grams that one text alone has cannot overlap and make no fragment.

Large groups of near copies are not expanded into pairs: a first round compares each
document with the smallest one under the same n-gram and size band; after that only pairs
of different components are compared, since links inside a component change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, Totals, digest, words_in
from .common import kept, window_hashes, word_hashes
from .components import components


#: Cells of the order: octaves of the number of texts, each in PARTS by the last bits of the hash.
PARTS = 4
CELLS = 10 * PARTS


@dataclass(frozen=True)
class Join:
    """Words per n-gram, and the least similarity in percent."""

    words: int = 5
    percent: int = 75


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """Different n-grams of a text as sorted 64-bit hashes; a shorter text is one n-gram."""
    return np.unique(window_hashes(word_hashes(words), n))


def sets(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """One row per different text: key, rep (its smallest doc_id), n (its n-grams), and, if it can
    have a partner, its prefix, its fragments (number, hashes) and how many n-grams each of
    CELLS cells of the order holds."""

    def each(key: bytes, doc_id: int, words: list[bytes], totals: Totals):
        own = shingles(words, p.words)
        n, many = len(own), totals.of(own)
        prefix, fragments, cells = None, None, None
        # Its partners have at least this part of its n-grams.
        if 100 * int((many > 1).sum()) >= p.percent * n:
            order = np.lexsort((own, many))
            ahead = order[: n - -(-p.percent * n // 100) + 1]
            prefix = own[ahead[many[ahead] > 1]].tobytes()
            octave = np.frexp(many.astype(float))[1]
            fragments = [(int(o), own[octave == o].tobytes()) for o in np.unique(octave[many > 1])]
            at = (np.minimum(octave, 1 + CELLS // PARTS) - 2) * PARTS + (own & np.uint64(PARTS - 1)).astype(np.int64)
            cells = np.bincount(at[many > 1], minlength=CELLS).tolist()
        yield key, doc_id, n, prefix, fragments, cells

    blocks = Blocks(docs, lower=True)
    schema = "key binary, rep long, n long, prefix binary, fragments array<struct<f:int,h:binary>>, cells array<int>"
    return blocks.with_totals(lambda words: shingles(words, p.words), each, schema)


def _postings(found: DataFrame, p: Join) -> DataFrame:
    """gram, rep, n, cells, band of every prefix; similar sizes are in one band or the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x, np.int64) for x in batch.column("prefix").to_pylist()]
            lengths = [len(x) for x in parts]
            n = np.repeat(batch.column("n").to_numpy(), lengths)
            grams = np.concatenate([np.zeros(0, np.int64), *parts])
            band = np.floor(np.log(np.maximum(n, 1)) / np.log(100 / p.percent)).astype(np.int32)
            cells = batch.column("cells").take(pa.array(np.repeat(np.arange(batch.num_rows), lengths)))
            arrays = [pa.array(grams), pa.array(np.repeat(batch.column("rep").to_numpy(), lengths)), pa.array(n), cells, pa.array(band)]
            yield pa.RecordBatch.from_arrays(arrays, names=["gram", "rep", "n", "cells", "band"])

    rows = found.where("prefix IS NOT NULL").select("rep", "n", "prefix", "cells")
    return rows.mapInArrow(run, "gram long, rep long, n long, cells array<int>, band int")


def _can_match(p: Join) -> str:
    """Condition on a pair: its sizes, and no more overlap than the smaller count of each cell, allow the limit."""
    most = "aggregate(zip_with(cells_a, cells_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    return f"100 * least(na, nb) >= {p.percent} * greatest(na, nb) AND {100 + p.percent} * {most} >= {p.percent} * (na + nb)"


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(batch.column("ha").to_pylist(), batch.column("hb").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b", "na", "nb")] + [pa.array(got, pa.int64())], names=["a", "b", "na", "nb", "common"])


def verified(pairs: DataFrame, found: DataFrame, p: Join) -> DataFrame:
    """Pairs (a, b, na, nb) whose similarity reaches the limit: overlap by fragment, summed."""
    parts = found.where("fragments IS NOT NULL").select("rep", F.inline("fragments"))
    second = pairs.join(parts.select(F.col("rep").alias("b"), "f", F.col("h").alias("hb")), "b")
    both = second.join(parts.select(F.col("rep").alias("a"), "f", F.col("h").alias("ha")), ["a", "f"])
    counted = both.select("a", "b", "na", "nb", "ha", "hb").mapInArrow(_overlaps, "a long, b long, na long, nb long, common long")
    total = counted.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= p.percent * (F.col("na") + F.col("nb") - F.col("common")))


def linked(found: DataFrame, p: Join = Join()) -> DataFrame:
    """node, component of every text (by rep) that is linked with another."""
    postings = kept(_postings(found, p), "postings")
    fits = F.expr(_can_match(p))
    least = postings.groupBy("gram", "band").agg(F.min(F.struct("rep", "n", "cells")).alias("first"), F.max("rep").alias("last"))
    stars = postings.join(least.where("first.rep < last"), ["gram", "band"]).where(F.col("first.rep") < F.col("rep"))
    stars = stars.select(
        F.col("first.rep").alias("a"), F.col("rep").alias("b"), F.col("first.n").alias("na"), F.col("n").alias("nb"),
        F.col("first.cells").alias("cells_a"), F.col("cells").alias("cells_b"),
    )
    tried = kept(stars.where(fits).select("a", "b", "na", "nb").distinct(), "pairs")
    links = kept(verified(tried, found, p).select("a", "b"), "links")
    label = components(links)
    placed = postings.join(label, postings.rep == label.node, "left").select("gram", "rep", "n", "cells", F.coalesce("component", "rep").alias("c"))
    placed = kept(placed, "postings-placed")
    split = placed.groupBy("gram").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("gram")
    open_ = kept(placed.join(split, "gram", "left_semi"), "postings-open")
    left = open_.select("gram", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("cells").alias("cells_a"), F.col("c").alias("ca"))
    right = open_.select("gram", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cells_b"), F.col("c").alias("cb"))
    rest = left.join(right, "gram").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & fits).select("a", "b", "na", "nb").distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti").select("a", "b", "na", "nb")
    more = kept(verified(rest, found, p).select("a", "b"), "links")
    return label if more.isEmpty() else components(links.union(more))


def keyed(docs: DataFrame, lower: bool = True) -> DataFrame:
    """Every row of docs with the key of its words (null without words)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", __key binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = (words_in(t, lower) for t in batch.column("text").to_pylist())
            keys = pa.array([digest(w) if w else None for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "__key"])

    return docs.mapInArrow(run, schema)


def classes(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """key, n_shingles, component of every different text that has words."""
    found = kept(sets(docs, p), "sets")
    label = linked(found, p)
    out = found.select("key", "rep", F.col("n").alias("n_shingles")).join(label, found.rep == label.node, "left")
    return out.select("key", "n_shingles", F.coalesce("component", "rep").alias("component"))


def similar(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A text without words has no n-grams and its own id as component. Rows with one doc_id and
    different texts stand for themselves by text. A missing doc_id gets a missing component.
    """
    known = kept(classes(docs, p), "classes").withColumnRenamed("key", "__class")
    rows = keyed(docs.select("doc_id", "text")).select("doc_id", "__key")
    out = rows.join(known, rows["__key"] == known["__class"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), component.cast("long").alias("component_id"))


def one_per_group(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """The rows of each group's smallest doc_id; rows alike in doc_id and words stay once.

    Rows without doc_id stay."""
    known = kept(classes(docs, p), "classes").select("component").distinct()
    rows = keyed(docs)
    alone = rows.where("doc_id IS NULL OR __key IS NULL")
    first = rows.where("doc_id IS NOT NULL AND __key IS NOT NULL").join(known, F.col("doc_id") == F.col("component"), "left_semi")
    return first.dropDuplicates(["doc_id", "__key"]).union(alone).drop("__key")
