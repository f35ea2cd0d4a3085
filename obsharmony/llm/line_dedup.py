"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines are near duplicates if few edits of a word (put in, left out or changed) turn one
into the other: one edit, or two where both lines are long. Every line emits hashed keys of
itself and of itself without each one of its words; lines that share a key are paired, the
pair's edit distance is verified on the words, and the earliest line stays. Earlier means
smaller doc_id, then smaller line number. Long lines within two edits are met under keys of
themselves without one and without two of their words. Not every two words are tried: the first
edit between two lines stands where they part, read from the front, the last one where they part,
read from the back. So the first word left out is one before which some lines with the same
beginning part, and the last one such a word seen from the end; both are found by grouping.

Before that, equal lines are reduced to their first occurrence by a partial aggregate, and
lines that cannot have a partner are set aside: one edit leaves either the first or the last
half of a line as it was, so a line none of whose halves occurs in another line is alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, forget, kept, mixed, stored, word_hashes

#: Writes a table and reads it back.
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Lines:
    """Shorter lines than min_words always stay; one edit is allowed from near_words words on,
    two from far_words on (never without it). The shorter of two lines decides."""

    min_words: int = 4
    near_words: int = 10
    far_words: int | None = None
    #: Long lines whose keys a task makes at once.
    chunk_lines: int = 2000
    #: Size of the bitmap that keeps texts without candidate lines out of a shuffle (a power of 2).
    filter_bits: int = 1 << 23


#: Every line with a word takes part; an edit to four words, two to twenty.
WHOLE = Lines(min_words=1, near_words=4, far_words=20)


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


#: Base of the polynomial hash of words (odd) and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)

_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))


@lru_cache(4)
def _first_powers(base: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(1 << 17, base, np.uint64), dtype=np.uint64)])


def _powers(base: int, n: int) -> np.ndarray:
    if n <= 1 << 17:
        return _first_powers(base)[: n + 1]
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)])


class _Rolled:
    """Hashes of any runs of the words of some lines that stand one behind the other."""

    def __init__(self, words: np.ndarray, n: np.ndarray):
        self.n = n
        self.start = np.cumsum(n) - n
        self.power = _powers(_BASE, len(words))
        self.head = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words) * _powers(_UNDO, len(words))[:-1], dtype=np.uint64)])

    @classmethod
    def of(cls, raws: list[bytes]) -> _Rolled:
        """From lines as words of 8 bytes."""
        return cls(np.frombuffer(b"".join(raws), np.uint64), np.array([len(raw) // 8 for raw in raws], np.int64))

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.head[b] - self.head[a]) * self.power[b]

    def without(self, line: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of lines without their words at first and last (one word, if these are equal)."""
        a, end = self.start[line], self.start[line] + self.n[line]
        between = np.maximum(last - first - 1, 0)
        front = self.run(a, a + first) * self.power[between] + self.run(a + first + 1, np.maximum(a + last, a + first + 1))
        return front * self.power[self.n[line] - 1 - last] + self.run(a + last + 1, end)


def _key(sums: np.ndarray, kind: int, *at: np.ndarray) -> np.ndarray:
    key = mixed(sums + np.uint64(kind))
    for k, x in enumerate(at):
        key = key + np.uint64(k + 3) * mixed(x.astype(np.uint64) + np.uint64(1))
    return mixed(key)


#: Eights of bytes of a word that are read in turn.
_WIDE = 16


class _Cut:
    """Lines and words of some texts, found at once: per line the text it is of, its number there, its words."""

    def __init__(self, texts: list[bytes]):
        self.whole = whole = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(whole, np.uint8)
        blank = _BLANK[self.bytes]
        edges = np.flatnonzero(np.diff(blank, prepend=True))
        self.starts, self.ends = edges[::2], edges[1::2]
        ends = np.flatnonzero(self.bytes == 10)
        upto = np.searchsorted(self.starts, ends)
        self.n = np.diff(upto, prepend=0)
        self.first = upto - self.n
        counts = np.array([text.count(b"\n") + 1 for text in texts], np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.other = np.flatnonzero(blank & (self.bytes != 32) & (self.bytes != 10))

    def lines(self, at: np.ndarray) -> list[bytes]:
        """Lines (with a word) with one space between words."""
        a, b = self.starts[self.first[at]], self.ends[self.first[at] + self.n[at] - 1]
        letters = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        plain = b - a - (letters[self.first[at] + self.n[at]] - letters[self.first[at]]) == self.n[at] - 1
        plain &= np.searchsorted(self.other, a) == np.searchsorted(self.other, b)
        whole = self.whole
        return [whole[i:j] if same else b" ".join(whole[i:j].split()) for i, j, same in zip(a.tolist(), b.tolist(), plain.tolist())]

    def rolled(self) -> _Rolled:
        """Hashes of the words by eight bytes at a time; those of very long words by themselves."""
        wide = np.ndarray(len(self.whole), "<u8", self.whole + bytes(8), strides=(1,))
        left, at = self.ends - self.starts, self.starts
        sums, use = left.astype(np.uint64), np.arange(len(left))
        for _ in range(_WIDE):
            part = wide[at] << (8 * np.maximum(0, 8 - left)).astype(np.uint64)
            sums[use] = mixed(sums[use] * np.uint64(_BASE) + part)
            more = np.flatnonzero(left > 8)
            left, at, use = left[more] - 8, at[more] + 8, use[more]
            if not len(use):
                break
        if len(use):
            sums[use] = word_hashes([self.whole[i:j] for i, j in zip(self.starts[use].tolist(), self.ends[use].tolist())])
        return _Rolled(sums, self.n)


def _line_hashes(lines: list[bytes]) -> np.ndarray:
    return word_hashes(lines).view(np.int64)


#: Texts that a task holds beside those that Spark hands it, and bytes of them that are cut at once (one text may be larger).
_TEXTS = 500
_CUT = 1 << 18


def _cuts(texts: list[bytes | None]) -> Iterator[tuple[int, _Cut]]:
    """Texts in stretches, each with the place of its first text."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1]) + 1
        if size >= _CUT:
            yield first, _Cut(held)
            first, held, size = i + 1, [], 0
    if held:
        yield first, _Cut(held)


def _part(m: np.ndarray) -> np.ndarray:
    """Length of a part of a line of m words: a third, rounded down to two leading bits, so that
    lines that differ by a word or two mostly have parts of one length."""
    third = m // 3
    low = np.maximum(0, np.frexp(third.astype(np.float64))[1] - 2)
    return third >> low << low


#: What a key is of: parts of a long line, or a half of a line.
FIRST, LAST, MIDDLE, HALF = 0, 1, 2, 3


def _sort_of(key: str) -> str:
    return f"cast({key} & 3 as int)"


def _near_keys(rolled: _Rolled, line: np.ndarray, p: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Lines (places in `line`) and keys of which a line and each line that may be near share one.

    The two lowest bits of a key say what it is of. One edit leaves a half: the shorter of two lines, of m words,
    fixes the halves, the first m // 2 words or the last m - m // 2; a line of n words is met as the shorter one
    (m = n) and as the longer (m = n - 1). Two edits leave a part: the shorter line fixes three parts of _part(m)
    words, the first, the one behind it and the last. If edits reach both the first and the last part, each has
    one, so the part between is as it was, moved by one word at most; else the first or the last part is."""
    n, a = rolled.n[line], rolled.start[line]
    made: list[tuple[np.ndarray, np.ndarray]] = []

    def add(use: np.ndarray, at: np.ndarray, long: np.ndarray, sort: int, kind: int) -> None:
        use = np.flatnonzero(use)
        begin = a[use] + at[use]
        key = _key(rolled.run(begin, begin + long[use]), 16 + kind, long[use])
        made.append((use, key & ~np.uint64(3) | np.uint64(sort)))

    short = (n >= p.near_words) & (n <= (p.far_words or n))
    for m, use_first, use_last in ((n, short, short), (n - 1, short & (n % 2 == 0), short & (n % 2 == 1))):
        add(use_first, np.zeros_like(n), m // 2, HALF, 0)
        add(use_last, n - (m - m // 2), m - m // 2, HALF, 1)
    if p.far_words:
        seen: list[np.ndarray] = []
        for m in (n, n - 1, n - 2):
            size, use = _part(m), n >= p.far_words
            for other in seen:
                use = use & (size != other)
            seen.append(size)
            add(use, np.zeros_like(n), size, FIRST, 2)
            add(use, n - size, size, LAST, 3)
            for step in (-1, 0, 1):
                add(use, size + step, size, MIDDLE, 4)
    places, keys = (np.concatenate(x) for x in zip(*made))
    order = np.lexsort((keys, places))
    places, keys = places[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (places[1:] != places[:-1]) | (keys[1:] != keys[:-1])
    return places[new], keys[new]


def occurrences(docs: DataFrame, p: Lines = WHOLE) -> DataFrame:
    """doc_id, line, hash and keys (8 bytes each) of every line that may be a duplicate; rows without id take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, _TEXTS):
            for first, cut in _cuts(_bytes(batch.column("text"))):
                line = np.flatnonzero(cut.n >= p.min_words)
                places, keys = _near_keys(cut.rolled(), line, p)
                ends = (8 * np.searchsorted(places, np.arange(len(line) + 1))).astype(np.int32)
                arrays = [
                    batch.column("doc_id").take(pa.array(first + cut.text[line])), pa.array(cut.number[line].astype(np.int32)),
                    pa.array(_line_hashes(cut.lines(line))), pa.Array.from_buffers(pa.binary(), len(line), [None, pa.py_buffer(ends), pa.py_buffer(keys)]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "line", "hash", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {kind}, line int, hash long, keys binary")


def _maybe(ids: DataFrame, place: str, bits: int) -> bytes:
    """Bitmap of hashed ids, of fixed size: what is not in it is not among the ids."""
    at = F.expr(f"pmod({place}, {bits})")
    rows = ids.groupBy(F.expr(f"bitmap_bucket_number(pmod({place}, {bits}) + 1)").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("m")
    )
    out = bytearray(bits // 8)
    for r in rows.collect():  # at most bits / 32768 rows of 4 KB
        out[(r.b - 1) * 4096 : r.b * 4096] = bytes(r.m)[: bits // 8]
    return bytes(out)


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a column of these, and the row of each."""
    sizes = np.asarray(pc.binary_length(column)) // 8
    return np.frombuffer(b"".join(column.to_pylist()), np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_keys(batch.column("keys"))[0])], names=["key"])


def _maybe_shared(firsts: DataFrame, shared: DataFrame, p: Lines) -> DataFrame:
    """hash and key of lines, without most of the keys that are not shared, so that few keys are shuffled for the join."""
    bitmap = _maybe(shared, "shiftright(key, 2)", p.filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            keys, line = _keys(batch.column("keys"))
            at = (keys >> 2) % p.filter_bits
            use = np.flatnonzero(known[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            yield pa.RecordBatch.from_arrays([batch.column("hash").take(pa.array(line[use])), pa.array(keys[use])], names=["hash", "key"])

    return firsts.select("hash", "keys").mapInArrow(run, "hash long, key long")


def _candidate_words(docs: DataFrame, wanted: DataFrame, p: Lines) -> DataFrame:
    """hash, words (hashed) and parts of each wanted line.

    The scan of the texts gives only lines that two bitmaps let pass, of documents with a first occurrence and
    of hashes of lines, so that no texts are shuffled; a join by hash takes out what they let pass wrongly."""
    of_docs = _maybe(wanted, "xxhash64(doc_id)", p.filter_bits)
    of_lines = _maybe(wanted, "hash", p.filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_docs, in_lines = np.frombuffer(of_docs, np.uint8), np.frombuffer(of_lines, np.uint8)
        for batch in _chunks(batches, _TEXTS):
            at = batch.column("__at").to_numpy()
            hashes, words = [], []
            texts = batch.column("text").filter(pa.array(in_docs[at >> 3] >> (at & 7) & 1, pa.uint8()).cast(pa.bool_()))
            for _, cut in _cuts(_bytes(texts)):
                own = cut.lines(np.flatnonzero(cut.n >= p.near_words))
                found = _line_hashes(own)
                at = found % p.filter_bits
                for i in np.flatnonzero(in_lines[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist():
                    hashes.append(found[i])
                    words.append(word_hashes(own[i].split(b" ")).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(words, pa.binary())], names=["hash", "words"])

    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    lines = texts.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(p.filter_bits)).alias("__at")).mapInArrow(run, "hash long, words binary")
    return lines.join(wanted.select("hash", "parts"), "hash").dropDuplicates(["hash"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each line and of it without each one of its words; `gone` is that word's place, -1 for none."""
    for batch in _chunks(batches, 2000):
        rolled = _Rolled.of(batch.column("words").to_pylist())
        n = rolled.n
        line = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(line)) - rolled.start[line]
        sums = np.concatenate([rolled.run(rolled.start, rolled.start + n), rolled.without(line, at, at)])
        gone = np.concatenate([np.full(len(n), -1), at]).astype(np.int32)
        hashes = np.asarray(batch.column("hash"))[np.concatenate([np.arange(len(n)), line])]
        yield pa.RecordBatch.from_arrays([pa.array(_key(sums, 7).view(np.int64)), pa.array(gone), pa.array(hashes)], names=["key", "gone", "hash"])


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether the word sequences (8 bytes a word) are at most one word edit apart."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    same = x == y[: len(x)]
    first = len(x) if same.all() else int(np.argmin(same))
    return bool((x[first + (len(x) == len(y)) :] == y[first + 1 :]).all())


def within(x: np.ndarray, y: np.ndarray, edits: int) -> bool:
    """Whether so many word edits turn x into y."""
    if abs(len(x) - len(y)) > edits:
        return False
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    first = n if same.all() else int(np.argmin(same))
    x, y = x[first:], y[first:]
    if not len(x) or not len(y):
        return len(x) + len(y) <= edits
    return edits > 0 and (within(x[1:], y[1:], edits - 1) or within(x[1:], y, edits - 1) or within(x, y[1:], edits - 1))


#: Words of a block: where lines part is looked for by blocks first, then by words in blocks that hold such a place.
_BLOCK = 8


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            yield batch.slice(i, size)


def _forks(batches: Iterator[pa.RecordBatch], size: int, step: int) -> Iterator[pa.RecordBatch]:
    """key and what stands next of beginnings and ends of lines that are a multiple of step words long.

    `at` is the length of a beginning, or -1 - the length of an end. Of single words (step 1) only those in the
    blocks of `open`. The empty ones are left out: there all lines part."""
    for batch in _chunks(batches, size):
        rolled = _Rolled.of(batch.column("words").to_pylist())
        n, made = rolled.n, []
        if step > 1:
            counts = n // step + 1
            line = np.repeat(np.arange(len(n)), counts)
            long = (np.arange(len(line)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
            sides = [(line, long, False), (line, long, True)]
        else:
            opened = batch.column("open").to_pylist()
            line = np.repeat(np.arange(len(n)), [_BLOCK * len(x) for x in opened])
            block = np.repeat(np.array([at for x in opened for at in x], np.int64), _BLOCK)
            long = np.where(block < 0, -1 - block, block) + np.tile(np.arange(_BLOCK), len(block) // _BLOCK)
            sides = [(line[block >= 0], long[block >= 0], False), (line[block < 0], long[block < 0], True)]
        for line, long, back in sides:
            line, long = line[(long > 0) & (long <= n[line])], long[(long > 0) & (long <= n[line])]
            a, end = rolled.start[line], rolled.start[line] + n[line]
            if back:
                key, after = rolled.run(end - long, end), rolled.run(np.maximum(end - long - step, a), end - long)
            else:
                key, after = rolled.run(a, a + long), rolled.run(a + long, np.minimum(a + long + step, end))
            made.append((_key(key, 1 + back), mixed(after), line, -1 - long if back else long))
        key, after, line, at = (np.concatenate(x) for x in zip(*made))
        hashes = np.asarray(batch.column("hash"))[line]
        arrays = [pa.array(key.view(np.int64)), pa.array(after.view(np.int64)), pa.array(hashes), pa.array(n[line].astype(np.int32)), pa.array(at.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "after", "hash", "n", "at"])


def _parting(forks: DataFrame) -> DataFrame:
    """The rows of _forks behind which lines part; `shorter`, whether one of these has fewer words than the row's."""
    found = forks.groupBy("key").agg(F.min("after").alias("a"), F.max("after").alias("b"), F.min("n").alias("least")).where("a <> b")
    return forks.join(found.select("key", "least"), "key").select("hash", "at", (F.col("least") < F.col("n")).alias("shorter"))


#: Words behind (or before) a place of which a key is made, and how many times as many the next key takes.
_REACH, _WIDER = 4, 4


def _reaches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """key of each beginning (or end) before a place and of the `reach` words behind that place, for growing reaches.

    `after` is the word at the place. A line that lacks such a word has the words from the place on instead, 0
    and no `at`. Where a key comes with several of these, lines part at the place and then agree for so long."""
    for batch in _chunks(batches, size):
        rolled, made = _Rolled.of(batch.column("words").to_pylist()), []
        places = batch.column("places").to_pylist()
        counts = [len(x or ()) + 2 for x in places]
        line = np.repeat(np.arange(len(places)), counts)
        at = np.array([k for x in places for k in (0, -1, *(y["at"] for y in x or ()))], np.int64)
        n = rolled.n[line]
        reach = _REACH
        while len(line):
            for back in (False, True):
                for lacks in (False, True):
                    long = -1 - at if back else at
                    use = ((at < 0) == back) & (long + reach + (not lacks) <= n)
                    long, own, end = long[use], rolled.start[line[use]], rolled.start[line[use]] + n[use]
                    skip = long + (not lacks)
                    if back:
                        outer, inner = rolled.run(end - long, end), rolled.run(end - skip - reach, end - skip)
                        word = rolled.run(end - skip, end - long)
                    else:
                        outer, inner = rolled.run(own, own + long), rolled.run(own + skip, own + skip + reach)
                        word = rolled.run(own + long, own + skip)
                    key = _key(outer + np.uint64(5) * mixed(inner), 8 + back, long, np.full(len(long), reach))
                    made.append((key, mixed(word), line[use], at[use], np.full(len(long), reach), np.full(len(long), lacks)))
            reach *= _WIDER
            use = np.where(at < 0, -1 - at, at) + reach <= n
            line, at, n = line[use], at[use], n[use]
        key, after, line, at, reach, lacks = (np.concatenate(x) for x in zip(*made))
        hashes = np.asarray(batch.column("hash"))[line]
        arrays = [pa.array(key.view(np.int64)), pa.array(after.view(np.int64)), pa.array(hashes), pa.array(at.astype(np.int32), mask=lacks), pa.array(reach.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "after", "hash", "at", "reach"])


#: Whom a row of _marks meets under its key: its like, or only the other of two sides.
LIKE, LEFT, RIGHT = 0, 1, 2


def _marks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Keys under which a line meets the lines at most two edits away, and no others.

    Without what two lines have in common at their beginning and their end, each of two edits stands at
    either end of what is left. Two changes leave out the same two places (LIKE); a change and a word put
    in, one place of the shorter line, which is among the two places of the longer; a word put in and
    another left out, one of each, at any places (LIKE); two put in, none of the shorter. Places are counted
    in what is left. A first place is one where lines part (`places`, or the first word), a last one likewise
    from the end; of two places, only those that leave one of the line's shared parts as it was, and of which
    either agrees with another line on the words towards the other (`reaches`), half of these at least."""
    for batch in _chunks(batches, size):
        rolled, hashes = _Rolled.of(batch.column("words").to_pylist()), np.asarray(batch.column("hash"))
        whole = rolled.run(rolled.start, rolled.start + rolled.n)
        yield _marked([(_key(whole, 1), np.arange(len(hashes)), LEFT)], hashes)
        ones, nears, few, pairs, held = [], [], [], [], 0
        columns = (batch.column(c).to_pylist() for c in ("parts", "places", "reaches"))
        for i, (n, parts, places, reaches) in enumerate(zip(rolled.n.tolist(), *columns)):
            # With the place whether a shorter line parts there.
            front, back = {0: True}, {n - 1: True}
            for x in places or ():
                if 0 <= x["at"] < n:
                    front[x["at"]] = x["shorter"]
                elif -n <= x["at"] < 0:
                    back[n + x["at"]] = x["shorter"]
            reached: dict[int, int] = {}
            for x in reaches or ():
                reached[x["at"]] = max(x["reach"], reached.get(x["at"], 0))
            one = front.keys() | back.keys()
            ones += [(i, at) for at in one]
            nears += [(i, f) for f, shorter in front.items() if shorter and f + 1 < n]
            sizes = _parts_near(n)
            least, most = min(sizes), max(sizes)
            if len(front) * len(back) <= _FEW:
                for f, first_meets in front.items():
                    here = reached.get(f, 0)
                    for e, last_meets in back.items():
                        if e > f and (asked := _asked_of(e - f - 2)) <= here and asked <= reached.get(e - n, 0):
                            if (parts >> FIRST & 1 and f >= least) or (parts >> LAST & 1 and e < n - least) or (parts >> MIDDLE & 1 and f < most and e >= n - most):
                                few.append((i, f, e, first_meets and last_meets))
                continue
            first, last = np.array(list(front)), np.array(list(back))
            first_meets, last_meets = np.array(list(front.values())), np.array(list(back.values()))
            first_reach, last_reach = np.array([reached.get(f, 0) for f in front]), np.array([reached.get(e - n, 0) for e in back])
            rows = max(1, _HELD // len(last))
            for k in range(0, len(first), rows):  # so that a long line needs no square of memory
                f, e = first[k : k + rows, None], last[None, :]
                use = np.zeros((len(f), len(last)), bool)
                if parts >> FIRST & 1:
                    use |= f >= least
                if parts >> LAST & 1:
                    use |= e < n - least
                if parts >> MIDDLE & 1:
                    use |= (f < most) & (e >= n - most)
                asked = _asked(e - f - 2)
                use &= (e > f) & (asked <= first_reach[k : k + rows, None]) & (asked <= last_reach[None, :])
                x, y = np.nonzero(use)
                pairs.append((np.full(len(x), i), first[k + x], last[y], first_meets[k + x] & last_meets[y]))
                held += len(x)
                if held > _HELD:
                    yield _marked(_left_out(rolled, ones, nears, pairs), hashes)
                    ones, nears, pairs, held = [], [], [], 0
        line, first, last, met = np.array(few, np.int64).reshape(-1, 4).T
        pairs.append((line, first, last, met.astype(bool)))
        yield _marked(_left_out(rolled, ones, nears, pairs), hashes)


#: Pairs of places whose keys are made at once, and pairs of a line that are gone through one by one.
_HELD, _FEW = 100_000, 64


@lru_cache(10_000)
def _parts_near(n: int) -> tuple[int, ...]:
    return tuple(_part(np.array([n, n - 1, n - 2])).tolist())


def _left_out(rolled: _Rolled, ones: list, nears: list, pairs: list) -> list:
    """Keys, lines and sides without one word, without two that a shorter line lacks, and without two places."""
    line, at = np.array(ones, np.int64).reshape(-1, 2).T
    single = rolled.without(line, at, at)
    made = [(_key(single, 3, at), line, LEFT), (_key(single, 1), line, RIGHT), (_key(single, 2), line, LIKE)]
    line, at = np.array(nears, np.int64).reshape(-1, 2).T
    made.append((_key(rolled.without(line, at, at + 1), 1), line, RIGHT))
    if pairs:
        line, first, last, met = (np.concatenate(x) for x in zip(*pairs))
        pair = rolled.without(line, first, last)
        made.append((_key(pair, 4, first, last - 1), line, LIKE))
        pair, line, first, last = pair[met], line[met], first[met], last[met]
        made += [(_key(pair, 1), line, RIGHT), (_key(pair, 3, first), line, RIGHT), (_key(pair, 3, last - 1), line, RIGHT)]
    return made


@lru_cache(10_000)
def _asked_of(between: int) -> int:
    return int(_asked(np.array([between]))[0])


def _asked(between: np.ndarray) -> np.ndarray:
    """The widest reach within so many words; 0 if there is none."""
    asked, reach = np.zeros(between.shape, np.int64), _REACH
    while between.size and reach <= between.max():
        asked[between >= reach] = reach
        reach *= _WIDER
    return asked


def _marked(made: list, hashes: np.ndarray) -> pa.RecordBatch:
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _, _ in made)]).view(np.int64)
    lines = np.concatenate([np.zeros(0, np.int64), *(line for _, line, _ in made)])
    sides = np.concatenate([np.zeros(0, np.int8), *(np.full(len(k), side, np.int8) for k, _, side in made)])
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sides), pa.array(hashes[lines])], names=["key", "side", "hash"])


def far_lines(words: DataFrame, wanted: DataFrame, p: Lines, keep: Keep = kept) -> DataFrame:
    """hash of each long line that has an earlier long line at most two edits away.

    Lines meet under keys only, the earliest of a key for all others, so no list of pairs is made."""
    far, size = words.where("parts > 0"), p.chunk_lines
    schema = "key long, after long, hash long, n int, at int"
    blocks = far.mapInArrow(lambda batches: _forks(batches, size, _BLOCK), schema)
    opened = _parting(blocks).groupBy("hash").agg(F.collect_list("at").alias("open"))
    # The first block of each side is always looked into.
    inside = F.concat(F.array(F.lit(0), F.lit(-1)), F.coalesce("open", F.array().cast("array<int>"))).alias("open")
    forks = keep(far.join(opened, "hash", "left").select("hash", "words", inside), "lines-opened").mapInArrow(lambda batches: _forks(batches, size, 1), schema)
    places = _parting(forks).groupBy("hash").agg(F.collect_list(F.struct("at", "shorter")).alias("places"))
    placed = keep(far.join(places, "hash", "left").select("hash", "words", "parts", "places"), "lines-placed")
    agreed = placed.mapInArrow(lambda batches: _reaches(batches, size), "key long, after long, hash long, at int, reach int")
    shared = agreed.groupBy("key").agg(F.min("after").alias("a"), F.max("after").alias("b")).where("a <> b").select("key")
    reaches = agreed.where("at IS NOT NULL").join(shared, "key", "left_semi").groupBy("hash").agg(F.collect_list(F.struct("at", "reach")).alias("reaches"))
    marks = placed.join(reaches, "hash", "left").select("hash", "words", "parts", "places", "reaches")
    marks = keep(marks.mapInArrow(lambda batches: _marks(batches, size), "key long, side byte, hash long"), "lines-marks")
    met = marks.groupBy("key").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b").select("key")
    at = F.struct("doc_id", "line", "hash")
    rows = keep(marks.join(met, "key", "left_semi").join(wanted.select("hash", at.alias("at")), "hash"), "lines-marked")
    first = rows.groupBy("key").agg(*[F.min(F.when(F.col("side") == i, F.col("at"))).alias(f"first{i}") for i in (LIKE, LEFT, RIGHT)])
    before = F.when(F.col("side") == LIKE, F.col(f"first{LIKE}")).when(F.col("side") == LEFT, F.col(f"first{RIGHT}")).otherwise(F.col(f"first{LEFT}"))
    return rows.join(first, "key").where(before < F.col("at")).select("hash").distinct()


def near_lines(docs: DataFrame, firsts: DataFrame, p: Lines = WHOLE, keep: Keep = kept) -> DataFrame:
    """hash of each line that has an earlier line one edit away, or two if both are long.

    Lines that leave out the same place and then agree are one edit apart, and so are a line and
    another without one word: per key, the earliest of each sort is the partner of all others, so
    no list of pairs inside a key is made.
    """
    # A line's keys and the lines are distinct, so a key that comes twice is of two lines.
    shared = keep(firsts.select("keys").mapInArrow(_all_keys, "key long").groupBy("key").count().where("count > 1").select("key"), "lines-shared")
    parts = F.expr(f"CASE WHEN {_sort_of('key')} = {HALF} THEN 0 ELSE shiftleft(1, {_sort_of('key')}) END")
    candidates = _maybe_shared(firsts, shared, p).join(shared, "key", "left_semi").groupBy("hash").agg(F.bit_or(parts).alias("parts"))
    wanted = keep(candidates.join(firsts.select("hash", "doc_id", "line"), "hash"), "lines-wanted")
    words = keep(_candidate_words(docs, wanted, p), "lines-words")
    short = words.where(F.octet_length("words") <= 8 * p.far_words) if p.far_words else words
    variants = short.mapInArrow(_variants, "key long, gone int, hash long")
    met = variants.groupBy("key").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b").select("key")
    at = F.struct(F.col("doc_id"), F.col("line"), F.col("hash")).alias("at")
    rows = keep(variants.join(met, "key", "left_semi").join(wanted, "hash").select("key", "gone", "hash", at), "lines-met")
    whole = F.col("gone") < 0
    same = rows.where(~whole).groupBy("key", "gone").agg(F.min("at").alias("same"))
    other = rows.groupBy("key").agg(F.min(F.when(whole, F.col("at"))).alias("whole"), F.min(F.when(~whole, F.col("at"))).alias("part"))
    best = rows.join(same, ["key", "gone"], "left").join(other, "key", "left")
    partner = F.when(whole, F.col("part")).otherwise(F.least("same", "whole"))
    pairs = best.select("hash", "at", partner.alias("partner")).where(F.col("partner") < F.col("at"))
    earliest = pairs.groupBy("hash").agg(F.min("partner").alias("partner")).select("hash", F.col("partner.hash").alias("other"))
    mine = words.withColumnRenamed("words", "mine")
    theirs = words.select(F.col("hash").alias("other"), F.col("words").alias("theirs"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [one_edit(a, b) for a, b in zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("hash")], names=["hash"]).filter(pa.array(good, pa.bool_()))

    near = earliest.join(mine, "hash").join(theirs, "other").select("hash", "mine", "theirs").mapInArrow(verify, "hash long")
    return near.union(far_lines(words, wanted, p, keep)).distinct() if p.far_words else near


def duplicate_lines(docs: DataFrame, p: Lines = WHOLE, keep: Keep = kept) -> DataFrame:
    """doc_id, lines: the numbers (from 0) of each document's lines that an earlier line repeats.

    Missing and empty texts have no lines to lose; rows without doc_id take no part; rows with
    one doc_id count as one document, so none of them loses a line to another.
    """
    seen = keep(occurrences(docs, p), "lines")
    firsts = seen.groupBy("hash").agg(F.min(F.struct("doc_id", "line", "keys")).alias("at"))
    firsts = keep(firsts.select("hash", "at.doc_id", "at.line", "at.keys"), "lines-first")
    near = near_lines(docs, firsts, p, keep)
    stays = firsts.join(near, "hash", "left_anti").select("hash", F.col("doc_id").alias("d"), F.col("line").alias("l"))
    # Occurrences that stay are few to a hash (one place); all others go.
    here = seen.select("doc_id", "line", "hash").distinct()
    gone = here.join(stays, (here.doc_id == stays.d) & (here.line == stays.l) & (here.hash == stays.hash), "left_anti")
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def dedup(docs: DataFrame, p: Lines = WHOLE) -> DataFrame:
    """Every row with its duplicate lines taken out of the text, and their number in n_removed.

    Other columns stay; a column named n_removed is replaced. Tables made on the way are deleted
    once the numbers of the lines to take out are written."""
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        table, path = stored(df, name)
        paths.append(path)
        return table

    gone = kept(duplicate_lines(docs, p, keep), "lines-gone")
    for path in paths:
        forget(docs.sparkSession, path)
    return _taken_out(docs.drop("n_removed"), gone, p)


#: Texts cross the shuffle in this form.
_PACK = ("zstd", 1)


def _taken_out(rows: DataFrame, gone: DataFrame, p: Lines) -> DataFrame:
    """Rows without their gone lines. Those that a bitmap shows to lose none pass by; the others are joined, texts compressed."""
    bitmap = _maybe(gone, "xxhash64(doc_id)", p.filter_bits)
    gone = gone.withColumnsRenamed({"doc_id": "__doc", "lines": "__gone"})
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = lambda types: ", ".join(f"`{name}` {kind}" for name, kind in types.items())

    def chosen(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap, np.uint8)
        for batch in _chunks(batches, _TEXTS):
            at = batch.column("__at").to_numpy()
            yield batch.filter(pa.array((known[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) == wanted))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chosen(batches, False):
            arrays = [batch.column(n) for n in fields]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.zeros(batch.num_rows, np.int64))], names=[*fields, "n_removed"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_PACK[0], compression_level=_PACK[1])
        for batch in chosen(batches, True):
            raws = _bytes(batch.column("text"))
            texts = pa.array([raw and codec.compress(raw, asbytes=True) for raw in raws], pa.binary())
            sizes = pa.array([raw and len(raw) for raw in raws], pa.int64())
            arrays = [texts if n == "text" else batch.column(n) for n in fields]
            yield pa.RecordBatch.from_arrays([*arrays, sizes], names=[*fields, "__size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_PACK[0])
        for batch in _chunks(batches, _TEXTS):
            texts, counts = [], []
            for raw, size, lines in zip(*(batch.column(c).to_pylist() for c in ("text", "__size", "__gone"))):
                text = codec.decompress(raw, size, asbytes=True) if raw else raw
                out = set(lines or ()) if text is not None else set()
                texts.append(b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in out) if out else text)
                counts.append(len(out))
            arrays = [pa.array(texts, pa.binary()).cast(pa.string()) if n == "text" else batch.column(n) for n in fields]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64())], names=[*fields, "n_removed"])

    marked = rows.withColumn("__at", F.expr(f"pmod(xxhash64(doc_id), {p.filter_bits})"))
    result = ddl(fields | {"n_removed": "long"})
    may = marked.mapInArrow(packed, ddl(fields | {"text": "binary", "__size": "long"}))
    joined = may.join(gone, may.doc_id == gone["__doc"], "left").drop("__doc")
    return marked.mapInArrow(untouched, result).union(joined.mapInArrow(run, result))
