"""The whole pipeline against a plain chain of its five stages."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import numpy as np

import corpus_pipeline
from obsharmony.llm import packing, registered

_BLANK = "\x20\x09-\x0d"


def _words(text: str | None) -> list[str]:
    return re.findall(f"[^{_BLANK}]+", text or "")


def _edits(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def documents() -> list[tuple]:
    """Prose of several lines with whole copies, near copies, copies word by word on other lines, shared passages and junk."""
    rng = random.Random(8)
    run = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    prose = lambda: "\n".join(" ".join(run(rng.randrange(12, 26))) for _ in range(5))
    base = [prose() for _ in range(12)]
    passage = " ".join(run(70))
    texts: list[str | None] = [*base, base[0], base[1], None, "", "too short", "a a a b " * 40, "# $ % " * 60]
    texts += [base[2].replace(" ", "\n", 1), re.sub(r"\s", " ", base[3]), re.sub(r"\S+$", "last", base[4])]
    words = base[5].split()
    texts += ["\n".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7))]
    texts += [" ".join(run(40)) + "\n" + passage + "\n" + " ".join(run(45)), " ".join([*run(30), passage, *run(50)])]
    texts += [" ".join([*run(8), passage, *run(21)]), "\n".join(base[6].split("\n")[:3] + [" ".join(run(40))])]
    return [(i * 3, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]


def chain(rows: list[tuple], con) -> dict[int, str]:
    """Ids and texts that the packing gets."""
    kept = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({registered.OP8_SQL})").fetchall() if k}
    texts = {i: t for i, t, *_ in rows if i in kept}

    lines = sorted((i, k, _words(x)) for i, t in texts.items() for k, x in enumerate(t.split("\n")) if _words(x))
    limit = lambda n: 0 if n < 4 else 1 if n < 20 else 2
    gone = {(i, k) for at, (i, k, w) in enumerate(lines) if any(_edits(w, v) <= limit(min(len(w), len(v))) for _, _, v in lines[:at])}
    lost = {i for i, _ in gone}
    texts = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if i not in lost or _words(t)}

    grams = {}
    for i, t in texts.items():
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if grams[a] and grams[b] and 100 * len(grams[a] & grams[b]) >= 75 * len(grams[a] | grams[b]):
                x, y = root[a], root[b]
                root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    texts = {i: t for i, t in texts.items() if root[i] == i}

    first: dict[tuple, int] = {}
    for i, t in texts.items():
        w = _words(t)
        for k in range(len(w) - 49):
            first[tuple(w[k : k + 50])] = min(i, first.get(tuple(w[k : k + 50]), i))
    out = {}
    for i, t in texts.items():
        w = _words(t)
        stays = [True] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                stays[k : k + 50] = [False] * 50
        left = [x for x, s in zip(w, stays, strict=True) if s]
        if left or len(left) == len(w):
            out[i] = t if all(stays) else " ".join(left)
    return out


def test_run_against_a_plain_chain(spark, tmp_path):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = chain(rows, con)
    assert 12 < len(want) < len(rows) - 6 and all(map(_words, want.values()))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got, windows = defaultdict(list), defaultdict(list)
    for r in pieces:
        got[r.doc_id].append((r.start, r.ids))
        windows[r.sequence_id].append((r.offset, r.length))
    encode = packing.Encoder(packing.tokenizer_path(), packing.ranks_path())
    ids = {i: np.frombuffer(b"".join(x for _, x in sorted(p)), "<u4").tolist() for i, p in got.items()}
    assert ids == {i: [*encode.slow(t), 1] for i, t in want.items()}
    for spans in windows.values():
        spans.sort()
        assert sum(n for _, n in spans) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_run_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
