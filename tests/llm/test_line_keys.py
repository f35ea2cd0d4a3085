"""Lines are cut and keyed in arrays; keys and texts that decide nothing are not shuffled."""

from __future__ import annotations

import random

import numpy as np
import pytest

from obsharmony.llm import line_dedup
from obsharmony.llm.line_dedup import WHOLE, Lines


def _texts(n: int) -> list[bytes]:
    rng = random.Random(9)
    words = ["a", "bc", "é世", "word" * 3, "x" * 17, "long" * 40, "\0", "a\0"]
    gaps = [" ", " ", " ", "  ", "\t", "\r", "\x0b", "\n", "\n\n", " \n"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(30))).encode() for _ in range(n)] + [b"", b"\n", b" ", b"end"]


@pytest.mark.parametrize("size", [1, 200, 1 << 18])
def test_lines_are_cut_as_split_cuts_them(size, monkeypatch):
    monkeypatch.setattr(line_dedup, "_CUT", size)
    texts, got, hashes = _texts(200), [], {}
    for first, cut in line_dedup._cuts(texts):
        at = np.flatnonzero(cut.n)
        got += zip((first + cut.text[at]).tolist(), cut.number[at].tolist(), cut.lines(at), cut.n[at].tolist())
        rolled = cut.rolled()
        runs = rolled.run(rolled.start[at], rolled.start[at] + rolled.n[at])
        for line, run in zip(cut.lines(at), runs.tolist()):
            hashes.setdefault(line, set()).add(run)
    want = [(i, k, line.split()) for i, text in enumerate(texts) for k, line in enumerate(text.split(b"\n")) if line.split()]
    assert got == [(i, k, b" ".join(words), len(words)) for i, k, words in want]
    assert all(len(x) == 1 for x in hashes.values()) and len(set.union(*hashes.values())) == len(hashes)


def test_near_lines_share_a_key():
    rng = random.Random(4)

    def edited(words: list[str]) -> list[str]:
        at, kind, out = rng.randrange(len(words)), rng.randrange(3), list(words)
        out[at : at + (kind != 0)] = [] if kind == 1 else [f"n{rng.randrange(99)}"]
        return out

    for _ in range(400):
        n = rng.randrange(5, 70)
        one = [f"w{rng.randrange(30)}" for _ in range(n)]
        two = edited(edited(one)) if n >= 23 else edited(one)
        cut = next(line_dedup._cuts([" ".join(one).encode(), " ".join(two).encode()]))[1]
        places, keys = line_dedup._near_keys(cut.rolled(), np.arange(2), WHOLE)
        assert set(keys[places == 0].tolist()) & set(keys[places == 1].tolist())


def test_keys_of_one_line_alone_are_not_shuffled(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(300)] + [(900 + i, f"same begin {'of both ' * 12} end {i}") for i in range(2)]
    p = Lines(min_words=1, near_words=4, far_words=20, filter_bits=1 << 20)
    firsts = line_dedup.occurrences(spark.createDataFrame(rows, "doc_id long, text string"), p)
    shared = line_dedup.kept(firsts.select("keys").mapInArrow(line_dedup._all_keys, "key long").groupBy("key").count().where("count > 1").select("key"), "t")
    assert 0 < line_dedup._maybe_shared(firsts, shared, p).count() < 60 < firsts.selectExpr("sum(octet_length(keys)) / 8 AS n").first().n


@pytest.mark.parametrize("bits", [1 << 15, 1 << 23])
def test_every_row_comes_through_whichever_way_it_takes(spark, bits):
    rows = [(i, f"only {i} here\nall rights reserved by us" if i % 3 else f"only {i} here", i % 5) for i in range(200)]
    rows += [(None, "all rights reserved by us", 1), (500, None, 2), (501, "", 3), (502, "all rights reserved by us", None), (502, "all rights reserved by us", None)]
    p = Lines(min_words=1, near_words=4, far_words=20, filter_bits=bits)
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3), p).collect()
    want = [(d, (t if d in (None, 1) or not t or "all" not in t else "\n".join(t.split("\n")[:-1])), n) for d, t, n in rows]
    order = lambda x: sorted(x, key=str)
    assert order((r.doc_id, r.text, r.n) for r in got) == order(want)
    assert sum(r.n_removed for r in got) == sum(a[1] != b[1] for a, b in zip(rows, want))
