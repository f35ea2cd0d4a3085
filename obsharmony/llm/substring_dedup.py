"""Removal of long passages that an earlier document has, by FM-indexes over shards.

Every window of `window` words holds an anchor: its word n-gram with the smallest hash, the
leftmost among equals. Equal windows have equal anchors, so only stretches of windows whose
anchor occurs in several texts matter; they are dealt to shards by anchor. Each shard
indexes its stretches in a compressed FM-index and streams them through it by backward
search; the matching statistics say where a match of at least `window` words with an
earlier document starts.

Equal texts, and then equal stretches, are reduced to their first owner by partial
aggregates before anything meets in a shard. An anchor with more stretches than one index
may hold is indexed in parts, and its stretches go through each part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, Totals, words_in
from .common import kept, mixed, window_hashes, word_hashes
from .fm_index import FMIndex
from .ngram_join import keyed


@dataclass(frozen=True)
class Passages:
    """Words per window and per anchor; words that one index holds."""

    window: int = 50
    gram: int = 8
    shard_words: int = 300_000


def anchors(hashes: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the place of its anchor and the anchor's hash."""
    if len(hashes) < p.window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = window_hashes(hashes, p.gram)
    span = p.window - p.gram + 1
    place = np.empty(len(grams) - span + 1, np.int64)
    for i in range(0, len(place), 50_000):
        part = np.lib.stride_tricks.sliding_window_view(grams[i : i + 50_000 + span - 1], span)
        place[i : i + len(part)] = part.argmin(1) + np.arange(i, i + len(part))
    return place, mixed(grams[place])  # the smallest hashes are crowded together; mixed, they spread


def stretches(docs: DataFrame, p: Passages = Passages()) -> DataFrame:
    """One row per different text: key, rep (smallest doc_id), n (words), and, if windows of it may
    be repeated, its word hashes and stretches (anchor, hash of the words, start, length)."""

    def each(key: bytes, doc_id: int, words: list[bytes], totals: Totals):
        hashes = word_hashes(words)
        place, grams = anchors(hashes, p)
        segs, raw = None, None
        if len(place):
            open_ = totals.of(grams) > 1
            edge = np.flatnonzero(np.diff(place, prepend=-1, append=-1) != 0)
            raw = hashes.tobytes()
            segs = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if open_[a]:
                    end = b - 1 + p.window
                    content = int(np.uint64(xxhash.xxh3_64_intdigest(raw[8 * a : 8 * end])).view(np.int64))
                    segs.append((int(grams[a].view(np.int64)), content, a, end - a))
        yield key, doc_id, len(words), segs or None, raw if segs else None

    def keys(words: list[bytes]) -> np.ndarray:
        return np.unique(anchors(word_hashes(words), p)[1])

    schema = "key binary, rep long, n long, segs array<struct<anchor:bigint,content:bigint,start:int,length:int>>, words binary"
    return Blocks(docs, lower=False).with_totals(keys, each, schema)


def _sharded(firsts: DataFrame, found: DataFrame, p: Passages) -> DataFrame:
    """Stretches to search, with their words, by shard: bucket and part; `held` ones are indexed there."""
    several = firsts.groupBy("anchor").agg(F.min("content").alias("x"), F.max("content").alias("y"), F.sum("first.length").alias("size"))
    several = kept(several.where("x <> y").select("anchor", "size"), "anchors")
    total = several.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / p.shard_words))
    parts = F.ceil(F.col("size") / p.shard_words).cast("int")
    wanted = firsts.join(several, "anchor").select("first.key", F.struct("anchor", "content", "first.rep", "first.start", "first.length", parts.alias("parts")).alias("s"))
    wanted = wanted.groupBy("key").agg(F.collect_list("s").alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                rows = [
                    (s["anchor"], s["content"], s["rep"], s["parts"], raw[8 * s["start"] : 8 * (s["start"] + s["length"])])
                    for raw, own in zip(part.column("words").to_pylist(), part.column("wanted").to_pylist())
                    for s in own
                ]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["anchor", "content", "rep", "parts", "words"])

    rows = found.where("segs IS NOT NULL").select("key", "words").join(wanted, "key").select("words", "wanted")
    rows = rows.mapInArrow(cut, "anchor long, content long, rep long, parts int, words binary")
    whole = F.col("parts") <= 1
    own = F.pmod("content", F.col("parts").cast("long")).cast("int")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    bucket = F.when(whole, F.pmod(F.xxhash64("anchor"), F.lit(buckets))).otherwise(F.col("anchor"))
    return rows.select(
        bucket.alias("bucket"), F.when(whole, -1).otherwise(F.col("part")).alias("part"), (own == F.col("part")).alias("held"),
        "anchor", "content", "rep", "words",
    )


def _searched(rows: DataFrame, p: Passages) -> DataFrame:
    """anchor, content, begin, end: words of a stretch in windows that a smaller doc_id has."""

    def search(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["content", "rep"], kind="stable")
        words = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        owners, held = pdf["rep"].to_numpy(np.int64), pdf["held"].to_numpy(bool)
        if not held.any():
            return pd.DataFrame([], columns=["anchor", "content", "begin", "end"])
        index = FMIndex([w for w, h in zip(words, held) if h], owners[held])
        out = []
        for anchor, content, match in zip(pdf["anchor"], pdf["content"], index.matching(words, owners)):
            hit = np.flatnonzero(match >= p.window)
            if len(hit):
                cut = np.flatnonzero(np.diff(hit) > 1)
                for a, b in zip(hit[np.r_[0, cut + 1]], hit[np.r_[cut, len(hit) - 1]]):
                    out.append((anchor, content, int(a), int(b) + p.window))
        return pd.DataFrame(out, columns=["anchor", "content", "begin", "end"])

    return rows.groupBy("bucket", "part").applyInPandas(search, "anchor long, content long, begin int, end int")


def covered(docs: DataFrame, p: Passages = Passages()) -> DataFrame:
    """key, rep, n, spans (begin, end in words, in the text of rep) of every different text."""
    found = kept(stretches(docs, p), "stretches")
    places = found.where("segs IS NOT NULL").select("key", "rep", F.inline("segs"))
    firsts = places.groupBy("anchor", "content").agg(F.min(F.struct("rep", "key", "start", "length")).alias("first"), F.max("rep").alias("last"))
    firsts = kept(firsts, "stretches-first")
    hits = kept(_searched(_sharded(firsts, found, p), p), "matches")
    owner = F.col("first.rep")
    later = places.join(firsts.where("first.rep < last"), ["anchor", "content"]).where(F.col("rep") > owner)
    later = later.select("key", F.col("start").alias("begin"), (F.col("start") + F.col("length")).alias("end"))
    own = places.join(firsts, ["anchor", "content"]).where(F.col("rep") == owner).select("key", "anchor", "content", "start")
    own = own.join(hits, ["anchor", "content"]).select("key", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))
    spans = later.union(own).groupBy("key").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    return found.select("key", "rep", "n").join(spans, "key", "left")


def dedup(docs: DataFrame, p: Passages = Passages()) -> DataFrame:
    """Every row with n_words, n_removed and kept_words (the words left, joined by one space).

    A missing or empty text has no words. Of equal texts, all but those of the smallest doc_id
    lose every window; rows alike in doc_id do not count as earlier than each other. A row
    without doc_id loses nothing and is evidence against none. Columns of the input named like
    the new ones are replaced.
    """
    known = kept(covered(docs, p), "covered").withColumnsRenamed({"key": "__class", "n": "__n", "spans": "__spans", "rep": "__rep"})
    plain = docs.drop("n_words", "n_removed", "kept_words")
    rows = keyed(plain, lower=False)
    rows = rows.join(known, rows["__key"] == known["__class"], "left").drop("__key", "__class", "__n")
    columns = plain.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields) + ", n_words long, n_removed long, kept_words string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                total, gone, texts = [], [], []
                for doc_id, text, rep, spans in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "__rep", "__spans"))):
                    words = words_in(text, False)
                    n = len(words)
                    if rep is not None and doc_id is not None:
                        if doc_id > rep:
                            words = words if n < p.window else []
                        elif spans:
                            keep = np.ones(n, bool)
                            for s in spans:
                                keep[s["begin"] : s["end"]] = False
                            words = [words[j] for j in np.flatnonzero(keep)]
                    total.append(n)
                    gone.append(n - len(words))
                    texts.append(b" ".join(words).decode("utf-8"))
                made = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *made], names=[*columns, "n_words", "n_removed", "kept_words"])

    return rows.select(*columns, "__rep", "__spans").mapInArrow(run, schema)
