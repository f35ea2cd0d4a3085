"""Corpus operators against brute force, with the odd rows each must stand."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from obsharmony.llm import (
    blocks, html_extraction, html_lines, line_dedup, nearest, ngram_join, packing, quality_classifier, quality_rules, registered,
    sentencepiece_viterbi, sharding, substring_dedup,
)
from obsharmony.llm.components import components
from obsharmony.llm.fm_index import FMIndex

DATA = Path("/root/testdata/sf0.001")
WORDS = [f"w{i}" for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, size string, score string, part int"


def corpus(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, repeated lines, missing and empty parts, long texts, repeated rows."""
    rng = random.Random(seed)
    run = lambda n: [rng.choice(WORDS) for _ in range(n)]
    base, passage = run(120), run(70)
    texts: list[str | None] = [None, "", " \t\n", "one", "two words here now", "Two words HERE now"]
    texts += [" ".join(base)] * 5 + [" ".join(base).upper()]
    for k in (1, 2, 4, 9, 20):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(len(near))] = "other"
        texts.append(" ".join(near))
    texts += [" ".join(run(30) + passage + run(20)) for _ in range(4)]
    line = " ".join(run(14))
    texts += ["\n".join([line, " ".join(run(12)), line, line.replace("w", "v", 1), " ".join(line.split()[1:]), "aa bb"]) for _ in range(3)]
    texts += ["aa bb cc " * 60, " ".join(run(9000)), "x" * 50_000, "aé世界 \U0001f600 b\r\n\x0bc d <|endoftext|>e  f   g", "## $$ %% " * 30]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, 0, "h", "s", "c", 1) for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[20], (None, " ".join(base), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(frame_module):
    return frame_module(SCHEMA, corpus())


@pytest.fixture(scope="module")
def frame_module(spark):
    return lambda schema, rows: spark.createDataFrame([tuple(r) for r in rows], schema).repartition(3)


@pytest.fixture(scope="module")
def none(frame_module):
    return frame_module(SCHEMA, [])


def split(text: str | None, pattern: str = "[^\x20\x09-\x0d]+") -> list[str]:
    return re.findall(pattern, text or "")


@pytest.mark.parametrize("name", sorted(registered.oracles()))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = registered.builders()[name](spark, str(DATA))
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registered.oracles()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want))


def test_quality_measures(docs, none):
    rows = quality_rules.with_verdicts(quality_rules.measure(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words, windows = split(r.text), Counter()
        grams = list(zip(words, words[1:], words[2:]))
        windows.update(grams)
        hit = {i + k for i, g in enumerate(grams) if windows[g] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if split(x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(words) < 50 or 2 * len(hit) > len(words))
        assert not (r.kept and r.base_failed)
    assert quality_rules.quality_filter(none).collect() == []
    assert quality_rules.quality_filter(docs).columns == docs.columns


def test_bad_host_is_rejected_and_small_one_is_not(frame_module):
    good = " ".join(WORDS[:80])
    rows = [(i, "no", "bad") for i in range(400)] + [(1000, good, "bad"), (1001, "no", "tiny"), (1002, good, "tiny")]
    rows += [(2000 + i, f"{good} {i}", f"h{i % 9}") for i in range(900)] + [(5000, good, None)]
    measured = quality_rules.measure(frame_module("doc_id long, text string, source string", rows))
    kept = {r.doc_id: r.kept for r in quality_rules.with_verdicts(measured).collect()}
    assert not kept[1000] and kept[1002] and kept[5000] and kept[2000]
    assert quality_rules.prior(0, 0, 0, 0.0, 1e6) == (0.5, 0.5)


def test_sharding_is_whole_and_even(docs, none):
    for size in (1 << 30, 4000):
        got = sharding.shard(docs, 4, bucket_bytes=size).collect()
        assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, ((r.doc_id, r.text) for r in docs.collect())))
        counts = Counter(r.shard for r in got)
        assert max(counts.values()) - min(counts.values()) <= 1
        for s in counts:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
        assert all(r["size"] == len((r.text or "").encode()) + 1 for r in got)
    assert sharding.shard(none).collect() == []


def test_shuffle_changes_the_order(spark):
    rows = spark.range(2000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    order = [r.doc_id for r in sharding.shard(rows, 1, bucket_bytes=1500).orderBy("slot").collect()]
    assert sorted(order) == list(range(2000)) and np.abs(np.corrcoef(order, range(2000))[0, 1]) < 0.2


def test_best_cuts_against_all_choices():
    rng = random.Random(2)
    for _ in range(200):
        places = sorted(rng.sample(range(1, 40), rng.randrange(3, 10)))
        full = sorted({*places, *range(4, places[-1], 7)})
        costs = [0 if rng.random() < 0.5 else 3 for _ in full]
        best: dict[int, float] = {0: 0}
        for at, cost in zip(full, costs):
            best[at] = min((best[i] + 8 - (at - i) + cost for i in best if at - i <= 8), default=float("inf"))
        cuts = packing.best_cuts(np.array(full), np.array(costs), 8)
        cost = dict(zip(full, costs))
        assert cuts[-1] == full[-1]
        assert sum(8 - (b - a) + cost[b] for a, b in zip([0, *cuts], cuts)) == best[full[-1]]


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encode = packing.Encoder(packing.tokenizer_path(), packing.ranks_path())
    odd = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x0660, 0x4E2D, 0xFFFD, 0x1F600]]
    texts = ["", *(f"a{c}1{c} {c}.{c}x  {c}{c}" for c in odd), "one<|endoftext|>two <|endoftext|>", "a" * 120_000]
    texts += [" " * 120_000 + "x", "\n" * 60_000 + "y " * 60_000, "we'll don't IT'S 3rd\r\n\t end. "]
    for t in texts:
        assert encode(t) == tokenizer.encode(t, add_special_tokens=False).ids
    assert {i for t in ("end.", "?", "!", "\n") for i in encode(t)[-1:]} <= set(np.flatnonzero(encode.ends).tolist())


def test_packing_holds_every_id_once(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    p = packing.Packing(run_tokens=5000)
    pieces = sorted(packing.pack(docs, p).collect(), key=lambda r: (r.sequence_id, r.offset))
    at: dict = {}
    for r in pieces:
        at[r.sequence_id] = at.get(r.sequence_id, 0)
        assert r.offset == at[r.sequence_id] and r.length * 4 == len(r.ids) > 0
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 2048
    for task in {s >> 33 for s in at}:  # runs of a few windows each cost a task at most one more than its tokens need
        own = [n for s, n in at.items() if s >> 33 == task]
        assert len(own) <= -(-sum(own) // 2048) + 1
    found = Counter()
    want = Counter((r.doc_id, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in docs.collect())
    open_: dict = {}
    for r in pieces:
        ids = open_.pop((r.doc_id, r.start), ()) + tuple(np.frombuffer(r.ids, "<u4").tolist())
        if len(ids) == r.doc_tokens:
            found[(r.doc_id, ids)] += 1
        else:
            open_[(r.doc_id, r.start + r.length)] = ids
    assert not open_ and found == want
    assert packing.pack(none).collect() == []


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, counts, y = rng.normal(size=(9, quality_classifier.WIDTH)), np.array([2, 4, 3]), np.array([1.0, 0, 1])
    model = quality_classifier.train(x, counts, y, quality_classifier.Learning(steps=3, batch=3))
    loss = lambda: -np.mean(y * np.log(s := model.forward(x, counts)["score"]) + (1 - y) * np.log(1 - s))
    for name, g in model.gradients(x, counts, y).items():
        w = np.atleast_1d(model.w[name]).ravel()
        for i in (0, len(w) - 1):
            old, shape = w[i], model.w[name].shape
            value = []
            for step in (1e-6, -1e-6):
                w[i] = old + step
                model.w[name] = w.reshape(shape)
                value.append(loss())
            w[i] = old
            model.w[name] = w.reshape(shape)
            assert np.atleast_1d(g).ravel()[i] == pytest.approx((value[0] - value[1]) / 2e-6, abs=1e-6)


def test_classifier_held_out(spark, docs, none, frame_module):
    table = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    model = quality_classifier.fit(table("documents"), table("labels"))
    scored = quality_classifier.score(table("documents"), model).join(table("labels"), "doc_id").where(quality_classifier.held_out()).collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in scored]) > 0.95
    odd = quality_classifier.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality_classifier.score(none, model).collect() == []
    blank = quality_classifier.fit(docs, frame_module("doc_id long, quality int, toxic int", [(3, None, 0)]))
    assert {r.score for r in quality_classifier.score(docs, blank).collect()} == {0.5}


class _Toy(sentencepiece_viterbi.Pieces):
    def __init__(self, scores: dict[str, float]):
        self.known = {p: (i, s) for i, (p, s) in enumerate(scores.items())}
        self.longest, self.bytes, self.unknown = max(map(len, scores)), {b: 1000 + b for b in range(256)}, -50.0


def test_streaming_viterbi_against_full_table():
    rng = random.Random(4)
    for _ in range(150):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))): -float(rng.randrange(1, 9)) for _ in range(6)}
        toy, text = _Toy(pieces), "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60)))
        best = [0.0]
        for j in range(1, len(text) + 1):
            fits = [best[i] + pieces[text[i:j]] for i in range(max(0, j - 3), j) if text[i:j] in pieces]
            best.append(max(fits, default=best[j - 1] - 50.0))
        viterbi, ids = sentencepiece_viterbi.StreamingViterbi(toy), []
        for i in range(0, len(text), 7):
            ids += viterbi.feed(text[i : i + 7])
        ids += viterbi.finish()
        names = list(pieces)
        assert "".join(names[i] if i < 1000 else chr(i - 1000) for i in ids) == text
        assert sum(pieces[names[i]] if i < 1000 else -50.0 for i in ids) == best[-1]


def test_pieces_round_trip_and_window(docs, none):
    read = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(docs), text="back")
    rows = read.collect()
    assert len(rows) == docs.count() and all(r.back == r.text for r in rows)
    assert sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(none)).collect() == []
    codec = sentencepiece_viterbi.Codec(sentencepiece_viterbi.model_path())
    viterbi = sentencepiece_viterbi.StreamingViterbi(codec.pieces)
    for _ in range(200):
        viterbi.feed("abcdefghij" * 10)
        assert len(viterbi.text) <= 8 * codec.pieces.longest  # the window stays bounded
    text = "the quick brown fox " * 50
    assert np.array(list(codec.stream(text[i : i + 13] for i in range(0, len(text), 13))), "<u4").tobytes() == codec.encode(text)


def test_nearest_exact_and_relaxed(frame_module):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).round(1)
    x[50:250] = x[50]  # a third of all rows are one vector
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(900, None, 0), (1000, [0.0] * 8, 0), (1100, [float("nan")] + [1.0] * 7, 0), (1200, [None] + [1.0] * 7, 0), (1300, [float("inf")] * 8, 0), (None, [1.0] * 8, 0)]
    table = frame_module("vec_id long, embedding array<float>, label int", rows + odd)
    x = x.astype(np.float32).astype(float)
    for factor, least in ((1.0, 1.0), (0.9, 0.9)):
        got = nearest.nearest(table.where("vec_id % 100 = 0"), table, 10, nearest.Trees(shard_rows=150, leaf=16, factor=factor)).collect()
        hit = 0
        for q in range(0, 600, 100):
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
            order = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
            mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
            assert [r.rank for r in mine] == list(range(1, 11))
            hit += len(set(order) & {r.vec_id for r in mine})
            assert all(r.score == pytest.approx(d[r.vec_id], abs=1e-12) for r in mine)
        assert hit >= least * 60 and len(got) == 60
    empty = table.where("vec_id < 0")
    assert nearest.nearest(empty, empty).collect() == []
    assert len(nearest.nearest(table.where("vec_id = 0"), table.where("vec_id < 4")).collect()) == 3


def test_nearest_sends_no_queries_through_the_driver(frame_module):
    rng = np.random.default_rng(2)
    table = frame_module("vec_id long, embedding array<float>", [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 4)))])
    p = nearest.Trees(shard_rows=30, leaf=8, block=7, spread=16, numbers=1 << 8, factor=1.0)  # 16 shards instead of 30
    assert (p.shards(900, 4), p.shards(300, 4), p.shards(9000, 4)) == (16, 10, 141)
    found = nearest.nearest(table.where("vec_id % 3 = 0"), table, 4, p)
    got = {(r.query_id, r.rank): r.vec_id for r in found.collect()}
    # The copies of the queries, one for each shard, were broadcast where the queries alone were small.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "MapInArrow" in plan
    x = np.array([r.embedding for r in table.orderBy("vec_id").collect()])
    for q in range(0, 900, 3):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert [got[q, r] for r in range(1, 5)] == [i for i in np.lexsort((np.arange(900), d)) if i != q][:4]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Top</header>
<nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div><div class=ad>Buy</div><!-- x <p>no</p> -->
<article><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp; text<p>Second line<br>third<script>var t="</p>";</script>
<form><input>Name</form><aside>Aside</aside><section id="comments"><p>Nice!</p></section></article><footer>&copy; x</footer>"""


def test_lines_of_a_page():
    kinds = html_lines.lines(PAGE)
    assert [t for t, k in kinds if k == html_lines.ARTICLE] == ["Title & more", "First bold text", "Second line", "third"]
    assert html_lines.lines(None) == html_lines.lines("") == html_lines.lines("<p>") == []
    assert html_lines.lines("a < b <p>c")[-1] == ("c", html_lines.OPEN)


def test_article_comes_before_class_words():
    page = '<main class="page with-sidebar"><article class="post has-related header"><p>Story<section id="comments"><article class="comment"><p>Nice!</article></section>' \
        '<article class="related"><p>Teaser</article></article></main><nav><article><p>Menu</article></nav>'
    assert [t for t, k in html_lines.lines(page) if k == html_lines.ARTICLE] == ["Story"]


def test_common_lines_against_table():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found, rest = html_extraction.common_lines(a, b), iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)


def test_page_differencing(frame_module):
    plain = lambda i: f"<body><div>Site name</div><p>Story {i} begins</p><p>and {i} goes on</p><div>Terms of use</div></body>"
    rows = [(i, f"http://h.example/a/{i:03}", plain(i), "t", 0) for i in range(40)]
    rows += [(100, "http://h.example/b", PAGE, "t", 0), (101, None, plain(101), "t", 0), (102, "http://alone.example/", plain(102), "t", 0)]
    rows += [(103, "http://h.example/c", None, "t", 0), (104, "http://h.example/d", "", "t", 0), rows[3], (None, "http://h.example/a/0031", plain(7), "t", 0)]
    pages = frame_module("page_id long, url string, html string, text string, n_chars int", rows)
    got = html_extraction.extract(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"Story {i} begins\nand {i} goes on" for i in range(40))
    assert text[100].startswith("Title & more") and text[103] == text[104] == ""
    assert text[101].split("\n")[0] == text[102].split("\n")[0] == "Site name"
    assert html_extraction.extract(pages.where("page_id < 0")).collect() == []


def _edit(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def _lines_left(rows: list[tuple], p: line_dedup.Lines) -> dict:
    every = sorted({(d, i, tuple(split(x))) for d, t in rows if d is not None for i, x in enumerate((t or "").split("\n")) if len(split(x)) >= p.min_words})
    gone: dict = {}
    for d, i, w in every:
        for e, j, v in every:
            if (e, j) >= (d, i):
                break
            if w == v or (min(len(w), len(v)) >= p.near_words and _edit(list(w), list(v)) <= 1):
                gone.setdefault(d, set()).add(i)
                break
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in rows if d is not None and t is not None}


def test_line_dedup_against_brute_force(frame_module, docs, none):
    rng, p = random.Random(6), line_dedup.Lines(filter_bits=1 << 16)
    base = [[rng.choice("ab" if k % 2 else WORDS) for _ in range(12)] for k in range(8)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(4):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice([[], ["zz"], [w[at]]])
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame_module("doc_id long, text string", rows), p).collect()}
    assert got == _lines_left(rows, p)
    small = docs.where("doc_id IS NULL OR doc_id < 24")
    plain = [(r.doc_id, r.text) for r in small.collect()]
    found = line_dedup.dedup(small, p).collect()
    assert len(found) == len(plain) and {r.doc_id: r.text for r in found if r.doc_id is not None and r.text is not None} == _lines_left(plain, p)
    assert line_dedup.dedup(none, p).collect() == []


@pytest.mark.parametrize("pair_lines", [200, 2])
def test_whole_line_dedup_against_brute_force(frame_module, pair_lines):
    rng, p = random.Random(16), line_dedup.Lines(1, 4, 20, pair_lines, 1 << 16)
    sizes = [1, 3, 4, 6, 9, 18, 19, 20, 21, 24, 24, 31]
    base = [[rng.choice("abc" if k % 2 else WORDS) for _ in range(n)] for k, n in enumerate(sizes)]
    rows = [(i, "All rights reserved.\n") for i in range(3)]
    for i in range(3, 40):
        lines = []
        for _ in range(4):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w)) if w else 0
                w[at : at + rng.randrange(2)] = rng.choice([[], ["zz"], [rng.choice("abc")]])
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    limit = lambda w, v: (0, 1, 2)[(m := min(len(w), len(v))) >= 4 and 1 + (m >= 20)]
    every = sorted((d, i, split(x)) for d, t in rows for i, x in enumerate(t.split("\n")) if split(x))
    gone = {(d, i) for k, (d, i, w) in enumerate(every) if any(_edit(w, v) <= limit(w, v) for _, _, v in every[:k])}
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    got = {r.doc_id: r.text for r in line_dedup.dedup(frame_module("doc_id long, text string", rows), p).collect()}
    assert got == want and (1, 0) in gone and (p.min_words, p.near_words, p.far_words) == (line_dedup.WHOLE.min_words, line_dedup.WHOLE.near_words, line_dedup.WHOLE.far_words)


def _grams(text: str | None) -> frozenset:
    w = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_ngram_join_against_brute_force(docs, none, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 20_000)
    rows = [(r.doc_id, _grams(r.text)) for r in docs.collect()]
    ids = sorted({d for d, _ in rows if d is not None})
    root = {d: d for d in ids}
    for d, a in rows:
        for e, b in rows:
            if d is not None and e is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root[d], root[e]
                root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    want = sorted((d, len(g), root[d]) for d, g in rows if d is not None)
    got = ngram_join.similar(docs).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == want
    assert len(got) == len(rows) and all(r.component_id is None for r in got if r.doc_id is None)
    left = {r.doc_id for r in ngram_join.one_per_group(docs).collect()}
    assert left - {None} == {d for d, g, c in want if d == c}
    assert ngram_join.similar(none).collect() == []


def test_near_copies_of_near_copies(frame_module):
    rng = random.Random(8)
    rows, chains = [], []
    for c in range(6):
        w = [rng.choice(WORDS) for _ in range(90)]
        for _ in range(12):
            w = list(w)
            w[rng.randrange(90)] = f"n{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(w)))
            chains.append(c)
    table = frame_module("doc_id long, text string", rows)
    grams = [_grams(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and 100 * len(grams[i] & grams[j]) >= 75 * len(grams[i] | grams[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if v in (x, y) else v for v in root]
    assert sorted((r.doc_id, r.component_id) for r in ngram_join.similar(table).collect()) == list(enumerate(root))


def test_components(frame_module):
    links = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 45), (7, 7)]
    got = {r.node: r.component for r in components(frame_module("a long, b long", links)).collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 45: 40, 50: 40}


def test_matching_statistics_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        k = rng.choice([1, 2, 3, 8])
        make = lambda n, k=k: np.array([rng.randrange(k) * 7919 + 5 for _ in range(n)], np.uint64)
        held = [make(rng.randrange(1, 14)) for _ in range(rng.randrange(1, 8))]
        owners = np.array([rng.randrange(6) for _ in held])
        asked, own = [*held, make(9)], np.append(owners, 99)
        for q, o, match in zip(asked, own, FMIndex(held, owners).matching(asked, own)):
            for i in range(len(q)):
                best = 0
                for s, so in zip(held, owners):
                    for j in range(len(s) if so < o else 0):
                        n = 0
                        while i + n < len(q) and j + n < len(s) and q[i + n] == s[j + n]:
                            n += 1
                        best = max(best, n)
                assert best == match[i]


@pytest.mark.parametrize("shard_words", [300_000, 150])
def test_substring_dedup_against_brute_force(docs, none, monkeypatch, shard_words):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    p = substring_dedup.Passages(shard_words=shard_words)
    rows = [(r.doc_id, split(r.text)) for r in docs.collect()]
    first: dict = {}
    for d, w in rows:
        for i in range(len(w) - 49 if d is not None else 0):
            first[tuple(w[i : i + 50])] = min(d, first.get(tuple(w[i : i + 50]), d))
    want = []
    for d, w in rows:
        keep = [True] * len(w)
        for i in range(len(w) - 49 if d is not None else 0):
            if first[tuple(w[i : i + 50])] < d:
                keep[i : i + 50] = [False] * 50
        left = " ".join(x for x, k in zip(w, keep) if k)
        want.append((str(d), len(w), len(w) - sum(keep), hashlib.sha256(left.encode()).hexdigest()))
    got = substring_dedup.dedup(docs, p).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept_words.encode()).hexdigest()) for r in got) == sorted(want)
    assert sum(x[2] for x in want) > 500
    if shard_words > 1000:
        assert substring_dedup.dedup(none).collect() == []


def test_pipeline_stages(spark, docs, frame_module):
    source = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "substring dedup", "packing"]
    left = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, left, str(DATA))
        assert new.columns == source.columns, name
        left = frame_module(source.schema, new.collect())
    base = corpus_pipeline.quality(spark, source, str(DATA)).collect()
    assert {r.doc_id for r in left.collect()} <= {r.doc_id for r in base}
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, str(DATA)).collect()
    assert sum(r.length for r in pieces if r.start == 0) > 0 and all(zlib.crc32(r.ids) >= 0 for r in pieces)
