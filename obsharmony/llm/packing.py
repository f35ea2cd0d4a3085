"""Packing of documents into token windows of bounded length, in order.

Documents are laid end to end in the order of doc_id, range-partitioned so that each task
holds one stretch of the order. Cuts are chosen by dynamic programming over document ends,
sentence ends and, inside very long sentences, every few tokens: cost is padding plus a
penalty per cut inside a document or sentence. The best predecessor of a cut is the minimum
over a sliding window of earlier cuts, kept in a monotone queue.
"""

from __future__ import annotations

import base64
import os
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Runs that the rank encoder is not given; texts of up to as many characters need no look.
_LONG = 50_000
_LONG_RUN = re.compile(rf"\S{{{_LONG}}}|\s{{{_LONG}}}")


@dataclass(frozen=True)
class Packing:
    """Window length, penalties in tokens of padding, and the bound of a worker's memory."""

    window: int = 2048
    sentence_penalty: int = 8
    token_penalty: int = 64
    #: Cuts offered inside a sentence longer than a quarter of a window, this far apart.
    step: int = 64
    end_id: int = 1
    #: Tokens that one pass of the dynamic program looks at.
    run_tokens: int = 1 << 19


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of texts, as the tokenizer file at `path` gives them.

    The rank file at `ranks` holds the same vocabulary, and its encoder gives the same ids in
    half of the time. Texts that hold a special token or a very long run go to the tokenizer.
    """

    def __init__(self, path: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken

        self.path, self.tokenizer = path, None
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.ends = np.zeros(max(known.values()) + 2, bool)
        for token, i in known.items():
            self.ends[i] = re.search(r"[.!?]\W*$|\n", token.decode("utf-8", "replace")) is not None

    def slow(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if "<|endoftext|>" in text or len(text) > _LONG and _LONG_RUN.search(text):
            return self.slow(text)
        return self.fast.encode_ordinary(text)


def cuts(ends: np.ndarray, sentences: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may end (positions from 0, sorted) and what a cut there costs.

    ends: positions after each document; sentences: positions after each sentence end."""
    total = int(ends[-1])
    cost = dict.fromkeys(sentences.tolist(), p.sentence_penalty) | dict.fromkeys(ends.tolist(), 0)
    places = np.array(sorted(cost), np.int64)
    before = np.concatenate([[0], places[:-1]])
    wide = np.flatnonzero(places - before > p.window // 4)
    extra = [np.arange(before[i] + p.step, places[i], p.step) for i in wide]
    at = np.concatenate([places, *extra])
    what = np.concatenate([np.array([cost[x] for x in places.tolist()]), *(np.full(len(x), p.token_penalty) for x in extra)])
    order = np.argsort(at, kind="stable")
    assert at[order[-1]] == total
    return at[order], what[order]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int, more: bool = False) -> list[int]:
    """Ends of the windows with the least padding plus cut costs.

    cost[j] = costs[j] + min over i with places[j] - places[i] <= window of
    cost[i] + window - (places[j] - places[i]); among equals the earliest i. If more tokens
    follow, the last window is still open, so its padding does not count.
    """
    places, costs = [0, *places.tolist()], [0, *costs.tolist()]
    key, back = [0] * len(places), [0] * len(places)
    queue: deque[int] = deque([0])
    for j in range(1, len(places)):
        at = places[j]
        while at - places[queue[0]] > window:
            queue.popleft()
        i = back[j] = queue[0]
        key[j] = k = key[i] + window + costs[j]  # the cost, plus the position
        while queue and key[queue[-1]] > k:
            queue.pop()
        queue.append(j)
    out, j = [], len(places) - 1
    if more:
        back[j] = min((i for i in range(j) if places[j] - places[i] <= window), key=lambda i: (key[i] - places[i], i))
    while j:
        out.append(places[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Packs a stream of documents; holds one run of tokens at a time."""

    def __init__(self, p: Packing, ends: np.ndarray, first: int):
        self.p, self.is_end, self.sequence = p, ends, first
        self.docs: list[tuple[object, int, int, np.ndarray]] = []  # id, tokens, start, ids not yet packed
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, len(ids), 0, ids))
        self.held += len(ids)
        return self.pack(False) if self.held >= self.p.run_tokens else []

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of the windows that are settled: all, or all but the last one of the run."""
        if not self.docs:
            return []
        ids = np.concatenate([d[3] for d in self.docs])
        ends = np.cumsum([len(d[3]) for d in self.docs])
        windows = best_cuts(*cuts(ends, np.flatnonzero(self.is_end[ids]) + 1, self.p), self.p.window, not last)
        if not last:
            windows = windows[:-1]
        pieces, at, doc = [], 0, 0
        for end in windows:
            begin = at
            while at < end:
                doc_id, tokens, start, own = self.docs[doc]
                origin = int(ends[doc]) - len(own)
                to = min(end, int(ends[doc]))
                pieces.append((doc_id, start + at - origin, ids[at:to].astype("<u4").tobytes(), tokens, self.sequence, at - begin))
                at = to
                doc += at == ends[doc]
            self.sequence += 1
        rest = self.docs[doc:]
        if rest:
            doc_id, tokens, start, own = rest[0]
            gone = at - (int(ends[doc]) - len(own))
            rest[0] = (doc_id, tokens, start + gone, own[gone:])
        self.docs, self.held = rest, int(ends[-1]) - at
        return pieces


def pack(docs: DataFrame, p: Packing = Packing(), path: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset. Every id of every document lies in exactly one piece.

    A missing or empty text is the end id alone. Order: doc_id, missing first; ties by a hash
    of the text. Repeated rows are packed each. Other columns of the input are not read. An
    empty table gives no rows.
    """
    path, ranks = path or tokenizer_path(), ranks or ranks_path()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, ranks)
        packer = Packer(p, encode.ends, TaskContext.get().partitionId() << 33)

        def out(pieces):
            doc_id, start, ids, tokens, sequence, offset = map(list, zip(*pieces))
            lengths = [len(x) // 4 for x in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_id, kind), *(pa.array(x, t) for x, t in ((start, pa.int64()), (lengths, pa.int64()), (ids, pa.binary()), (tokens, pa.int64()), (sequence, pa.int64()), (offset, pa.int64())))],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*encode(text or ""), p.end_id], "<u4")
                    if pieces := packer.add(doc_id, ids):
                        yield out(pieces)
        if pieces := packer.pack(True):
            yield out(pieces)

    rows = docs.select("doc_id", "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
