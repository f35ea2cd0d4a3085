"""Blocks of different texts, and which keys occur in more than one text.

Work that compares texts needs to know which of a text's keys (n-grams, anchors) other texts
have too. Texts are dealt to blocks by a hash; equal texts collapse, first inside each scan
task, then inside the block, so no group of copies meets in one task. Each block sends its
keys, packed as numbers, to buckets of the key space; each bucket answers every block with
those keys that occur in two texts or more. Blocks and buckets have bounded size; there are
more of them on larger input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
#: Text per bucket of keys: about a key of four bytes for each six bytes of text.
BUCKET_BYTES = 8 << 20


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def words_in(text: str | None, lower: bool) -> list[bytes]:
    """Words of a text as bytes; bytes know ASCII blanks and ASCII case only."""
    raw = (text or "").encode("utf-8", "replace")
    return (raw.lower() if lower else raw).split()


class Blocks:
    """docs (doc_id, text) as blocks; `lower` takes A-Z as a-z. Rows without doc_id are left out."""

    def __init__(self, docs: DataFrame, lower: bool):
        self.lower = lower
        self.docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        total = self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = max(1, math.ceil(total / BLOCK_BYTES))
        self.bits = max(2, math.ceil(math.log2(max(1, total / BUCKET_BYTES))))
        self.rows = self.docs.mapInArrow(_dealt(self.count, lower), "block int, key binary, doc_id long, words binary")

    def repeated(self, keys: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
        """block, bucket, values, totals: the keys of the block that two texts or more have.

        `keys` gives a text's different 64-bit keys; their first 32 + bits bits count."""
        bits = self.bits

        def send(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
            found = [keys(words.split()) >> np.uint64(32 - bits) for _, _, words in texts(pdf)]
            values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            cut = np.searchsorted(values, np.arange((1 << bits) + 1).astype(np.uint64) << np.uint64(32))
            out = []
            for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])):
                if j > i:
                    low, n = values[i:j].astype("<u4"), counts[i:j]
                    out.append((b, key[0], low.tobytes(), np.flatnonzero(n > 1).astype("<u4").tobytes(), n[n > 1].astype("<u4").tobytes()))
            return pd.DataFrame(out, columns=["bucket", "block", "values", "places", "counts"])

        def answer(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
            parts = [np.frombuffer(v, "<u4") for v in pdf["values"]]
            counts = []
            for part, places, more in zip(parts, pdf["places"], pdf["counts"]):
                n = np.ones(len(part), np.int64)
                n[np.frombuffer(places, "<u4")] = np.frombuffer(more, "<u4")
                counts.append(n)
            every = np.concatenate(parts)
            values, inverse = np.unique(every, return_inverse=True)
            total = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)[inverse]
            out, at = [], 0
            for block, part in zip(pdf["block"], parts):
                own = total[at : at + len(part)]
                at += len(part)
                many = own > 1
                if many.any():
                    out.append((block, key[0], part[many].tobytes(), own[many].astype("<u4").tobytes()))
            return pd.DataFrame(out, columns=["block", "bucket", "values", "totals"])

        sent = self.rows.groupBy("block").applyInPandas(send, "bucket int, block int, values binary, places binary, counts binary")
        return sent.groupBy("bucket").applyInPandas(answer, "block int, bucket int, values binary, totals binary")

    def with_totals(self, keys: Callable, each: Callable, schema: str) -> DataFrame:
        """`each(key, doc_id, words, Totals)` gives output rows (tuples) of every different text."""
        bits, names = self.bits, [f.split()[0] for f in schema.split(", ")]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            totals = Totals(right, bits)
            out = [row for key, doc_id, words in texts(left) for row in each(key, doc_id, words.split(), totals)]
            return pd.DataFrame(out, columns=names)

        return self.rows.groupBy("block").cogroup(self.repeated(keys).groupBy("block")).applyInPandas(run, schema)


class Totals:
    """How many texts have a key: 1 unless the bucket's answer says more."""

    def __init__(self, answers: pd.DataFrame, bits: int):
        self.bits = bits
        answers = answers.sort_values("bucket")
        low = [np.frombuffer(v, "<u4").astype(np.uint64) + (np.uint64(b) << np.uint64(32)) for b, v in zip(answers["bucket"], answers["values"])]
        self.values = np.concatenate([np.zeros(0, np.uint64), *low])
        self.totals = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(t, "<u4").astype(np.int64) for t in answers["totals"])])

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.values):
            return np.ones(len(keys), np.int64)
        short = keys >> np.uint64(32 - self.bits)
        at = np.minimum(np.searchsorted(self.values, short), len(self.values) - 1)
        return np.where(self.values[at] == short, self.totals[at], 1)


def texts(pdf: pd.DataFrame) -> Iterator[tuple[bytes, int, bytes]]:
    """Different texts of a block: key, smallest doc_id, words."""
    first, words = {}, {}
    for key, doc_id, own in zip(pdf["key"], pdf["doc_id"], pdf["words"]):
        key = bytes(key)
        first[key] = min(first.get(key, doc_id), doc_id)
        if own is not None:
            words[key] = bytes(own)
    for key in sorted(words):
        yield key, int(first[key]), words[key]


def _dealt(count: int, lower: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}
        less: dict[bytes, int] = {}

        def out(rows):
            block, key, doc_id, words = map(list, zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(key, pa.binary()), pa.array(doc_id, pa.int64()), pa.array(words, pa.binary())],
                names=["block", "key", "doc_id", "words"],
            )

        place = lambda key: int.from_bytes(key[:8], "little") % count
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(at, 1000), []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    words = words_in(text, lower)
                    if not words:
                        continue
                    key = digest(words)
                    if key not in sent:
                        sent[key] = doc_id
                        rows.append((place(key), key, doc_id, b" ".join(words)))
                    elif doc_id < min(sent[key], less.get(key, doc_id + 1)):
                        less[key] = doc_id
                if rows:
                    yield out(rows)
        if less:
            yield out([(place(k), k, d, None) for k, d in less.items()])

    return run
