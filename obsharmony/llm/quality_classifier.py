"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from counts of its characters and
words; gated attention weights, learnt from document labels alone, say which passages
matter; the weighted sum of the encodings gives the score. Labels come from a sample of
bounded, documented size; scoring reads every passage of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import word_hashes

#: Classes of bytes whose shares describe a passage; the last one takes the rest.
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "|", "#", "$", "%", "&", "*", "<>", "'\"-()", "@/:_=+"]


@dataclass(frozen=True)
class Learning:
    """max_labelled bounds the labelled rows that training sees (those with the smallest hash)."""

    passage_words: int = 48
    max_labelled: int = 6000
    hidden: int = 16
    gate: int = 8
    steps: int = 400
    batch: int = 512
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 11


def _byte_classes() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    for i, chars in enumerate(_CLASSES):
        table[list(chars.encode())] = i
    table[128:] = len(_CLASSES) + 1
    return table


_TABLE = _byte_classes()
_KINDS = len(_CLASSES) + 2
WIDTH = _KINDS + 7


def passages(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the number of passages per text.

    A text without words is one passage of zeros."""
    words = [(t or "").encode("utf-8", "replace").split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    counts = np.maximum(1, -(-lengths // size))
    first = np.cumsum(counts) - counts
    flat = [w for ws in words for w in ws]
    n, total = len(flat), int(counts.sum())
    out = np.zeros((total, WIDTH), np.float32)
    if not n:
        return out, counts
    doc = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    passage = first[doc] + place // size
    data = np.frombuffer(b"".join(flat), np.uint8)
    width = np.fromiter(map(len, flat), np.int64, n)
    start = np.cumsum(width) - width
    chars = np.bincount(passage, width, total)
    kinds = np.bincount(np.repeat(passage, width) * _KINDS + _TABLE[data], minlength=total * _KINDS).reshape(total, _KINDS)
    held = np.maximum(np.bincount(passage, minlength=total), 1)
    hashes = word_hashes(flat)
    order = np.lexsort((hashes, passage))
    new = np.ones(n, bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    again = np.zeros(n, bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    upper = _TABLE[data[start]] == 1
    shout = upper & (width > 1) & (_TABLE[data[np.minimum(start + 1, len(data) - 1)]] == 1)
    odd = _TABLE[data[start + width - 1]] > 4
    out[:, :_KINDS] = kinds / np.maximum(chars, 1)[:, None]
    out[:, _KINDS] = chars / held / 10
    out[:, _KINDS + 1] = np.bincount(passage[order], new, total) / held
    out[:, _KINDS + 2] = np.bincount(passage, again, total) / held
    out[:, _KINDS + 3] = np.bincount(passage, shout, total) / held
    out[:, _KINDS + 4] = np.bincount(passage, odd, total) / held
    out[:, _KINDS + 5] = np.log1p(np.bincount(passage, minlength=total)) / 4
    out[:, _KINDS + 6] = np.repeat(np.log1p(lengths) / 8, counts)
    return out, counts


class Model:
    """Encoder, gated attention and classifier; weights as plain arrays."""

    def __init__(self, weights: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray):
        self.w, self.mean, self.scale = weights, mean, scale

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["encode"] + w["encode_b"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["attend"]
        first = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        logit = z @ w["out"] + w["out_b"]
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "first": first, "score": 1 / (1 + np.exp(-logit))}

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, counts)
        d = (f["score"] - y) / len(y)
        dz = d[:, None] * w["out"]
        da = (dz[f["bag"]] * f["h"]).sum(1)
        mean = np.add.reduceat(f["a"] * da, f["first"])
        de = f["a"] * (da - mean[f["bag"]])
        dtg = de[:, None] * w["attend"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[f["bag"]] + dt @ w["tanh"].T + dg @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "out": f["z"].T @ d, "out_b": d.sum(), "attend": (f["t"] * f["g"]).T @ de, "tanh": f["h"].T @ dt,
            "gate": f["h"].T @ dg, "encode": f["x"].T @ dx, "encode_b": dx.sum(0),
        }

    def score(self, texts: list[str | None], size: int) -> np.ndarray:
        return self.forward(*passages(texts, size))["score"]


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, p: Learning) -> Model:
    """Fit by Adam on batches of documents; the same rows in the same order give the same model."""
    rng = np.random.default_rng(p.seed)
    mean, scale = x.mean(0), x.std(0) + 0.05
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Model(
        {
            "encode": start(x.shape[1], p.hidden), "encode_b": np.zeros(p.hidden), "tanh": start(p.hidden, p.gate),
            "gate": start(p.hidden, p.gate), "attend": start(p.gate), "out": start(p.hidden), "out_b": np.zeros(()),
        },
        mean, scale,
    )
    first = np.cumsum(counts) - counts
    one = {k: np.zeros_like(v) for k, v in model.w.items()}
    two = {k: np.zeros_like(v) for k, v in model.w.items()}
    for step in range(1, p.steps + 1):
        pick = rng.choice(len(y), min(p.batch, len(y)), replace=False)
        rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in pick])
        for k, g in model.gradients(x[rows], counts[pick], y[pick]).items():
            g = g + p.decay * model.w[k]
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.999 * two[k] + 0.001 * g * g
            model.w[k] = model.w[k] - p.rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees; a missing id counts as the empty text, so as held out."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, p: Learning = Learning(), label: str = "quality") -> Model:
    """Model from labelled rows that are not held out; none known: a model that says 0.5.

    At most p.max_labelled labels are used, those whose hash is smallest; the ids of such a
    sample are few, so they are broadcast, and their features are what the driver gathers.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", F.col(label).cast("double").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(p.max_labelled)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, counts = passages(batch.column("text").to_pylist(), p.passage_words)
            parts = np.split(x, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([v.tobytes() for v in parts], pa.binary())], names=["doc_id", "y", "x"]
            )

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
    got = rows.mapInArrow(features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y double, x binary").collect()
    if not got:
        return Model({"encode": np.zeros((WIDTH, 1)), "encode_b": np.zeros(1), "tanh": np.zeros((1, 1)), "gate": np.zeros((1, 1)), "attend": np.zeros(1), "out": np.zeros(1), "out_b": np.zeros(())}, np.zeros(WIDTH), np.ones(WIDTH))
    got.sort(key=lambda r: (r.doc_id, r.y, bytes(r.x)))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, WIDTH) for r in got]
    return train(np.concatenate(bags).astype(float), np.array([len(b) for b in bags]), np.array([r.y for r in got]), p)


def score(docs: DataFrame, model: Model, p: Learning = Learning()) -> DataFrame:
    """doc_id and score of every row; missing and empty texts are one passage of zeros.

    Repeated rows are scored each. Only doc_id and text are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = model.score(part.column("text").to_pylist(), p.passage_words)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
