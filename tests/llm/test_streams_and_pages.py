"""The query paths of the piece encoder and of page differencing against brute force."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from obsharmony.llm import html_extraction, html_lines
from obsharmony.llm.sentencepiece_viterbi import MARK, PART, Codec, StreamingViterbi, decode, encode, model_path


@pytest.fixture(scope="module")
def codec():
    return Codec(model_path())


def _best(codec: Codec, text: str) -> list[int]:
    """Ids by the whole table of boundaries, kept to the end of the text."""
    pieces, marked = codec.pieces, MARK + text.replace(" ", MARK)
    best: list[tuple[float, list[int]]] = [(0.0, [])]
    for j in range(1, len(marked) + 1):
        found = None
        for i in range(max(0, j - pieces.longest), j):
            fit = pieces.known.get(marked[i:j])
            if fit and (found is None or best[i][0] + fit[1] > found[0]):
                found = (best[i][0] + fit[1], best[i][1] + [fit[0]])
        best.append(found or (best[j - 1][0] + pieces.unknown, best[j - 1][1] + pieces.fallback(marked[j - 1])))
    return best[-1][1]


TEXTS = ["a", " ", "  two  spaces ", "plain words, and plain words again", "é世界 \U0001f600▁x\ny\tz", "trailing   ", "supercalifragilistic" * 9, "a" * 200, "▁▁"]


def test_ids_equal_those_of_the_whole_table(codec):
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice("abcdeé世 \n.\U0001f600") for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    plain = Codec(model_path(), remember=False)
    for text in texts:
        want = np.array(_best(codec, text), "<u4").tobytes()
        assert codec.encode(text) == plain.encode(text) == want
        size = rng.randrange(1, 9)
        assert np.array(list(codec.stream(text[i : i + size] for i in range(0, len(text), size))), "<u4").tobytes() == want
    assert codec.encode("") == b""


def test_ids_are_final_where_paths_meet(codec):
    """Along a text, ids leave the window before the text ends, and the window stays small."""
    text = MARK + MARK.join(["streaming", "words", "supercalifragilistic" * 30, "end"] * 200)
    viterbi, out, widest = StreamingViterbi(codec.pieces), [], 0
    for i in range(0, len(text), 64):
        spans = viterbi.spans(text[i : i + 64])
        out += spans
        widest = max(widest, len(viterbi.text))
    assert sum(n for n, _ in out) > 0.99 * len(text) - 200 and widest < 64 + 8 * codec.pieces.longest
    out += viterbi.last_spans()
    assert sum(n for n, _ in out) == len(text) and viterbi.text == ""


def test_long_text_and_odd_rows_round_trip(spark, codec):
    long = "word " * 20_000 + "x" * (3 * PART) + " é" * 5000
    rows = [(1, long, "i"), (2, None, "i"), (3, "", "i"), (4, long, "i"), (4, "same", "i"), (4, "same", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = decode(encode(docs), text="back").collect()
    assert len(got) == len(rows) and all(r.back == r.text for r in got)


HOSTILE = ["<a '" * 250_000, "<a " * 300_000, "<div>" * 200_000 + "</p>" * 100_000, "<a '\">" * 170_000, "<script>" + "</script" * 120_000, "<!--" * 250_000, "<" * 1_000_000]


@pytest.mark.parametrize("page", HOSTILE, ids=range(len(HOSTILE)))
def test_broken_pages_of_a_megabyte_are_read_in_linear_time(page):
    begin = time.process_time()
    html_lines.lines(page)
    assert time.process_time() - begin < 10  # hours where each tag scans the rest of the page


def test_tags_end_outside_quotes_or_at_the_first_sign():
    text = lambda page: [t for t, _ in html_lines.lines(page)]
    assert text("<p title='a > b'>one<p title=\"it's\">two") == ["one", "two"]
    assert text("<p title='open>one</p><p>two") == ["one", "two"]
    assert text("a < b <p>c <d") == ["a < b", "c <d"]
    assert text("<p>x</script\n>y<script>no</script >z") == ["xyz"]


def _lcs(a: list[str], b: list[str]) -> set[int]:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    i, j, out = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif table[i - 1][j] == table[i][j]:
            i -= 1
        else:
            j -= 1
    return out


def test_unmarked_sites_against_a_plain_differencing(spark):
    """Two sites without article marks: lines of every page come from a brute-force alignment with its neighbours."""
    rng = random.Random(5)
    rows, lines = [], {}
    for site in range(2):
        frame = [f"frame {site} {k}" for k in range(3)]
        for i in range(60):
            own = [f"story {site} {i} line {k} " + "w" * rng.randrange(40, 80) for k in range(rng.randrange(3, 8))]
            page = frame[:2] + own + frame[2:]
            path = f"/s{i % 7}/{i:03}"
            lines[site, path] = page
            rows.append((1000 * site + i, f"http://site{site}.example{path}", "".join(f"<p>{x}</p>" for x in page)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.url: r for r in html_extraction.extract(pages).collect()}
    order = sorted(lines)
    for at, (site, path) in enumerate(order):
        own = lines[site, path]
        near = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order) and order[k][0] == site]
        near.sort(key=lambda o: -html_extraction._nearness(path, o[1]))
        gone: set[int] = set()
        for other in near:
            gone = _lcs(own, lines[other])
            if sum(len(own[k]) for k in gone) <= html_extraction.COPY_SHARE * sum(map(len, own)):
                break
            gone = set()
        r = got[f"http://site{site}.example{path}"]
        assert r.text == "\n".join(x for k, x in enumerate(own) if k not in gone) and r.n_shared == len(gone) == 3


def _site(spark, host: str, pages: list[tuple[str, str]]) -> dict:
    rows = [(i, f"http://{host}{path}", body) for i, (path, body) in enumerate(pages)]
    return {r.page_id: r for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}


def test_marked_pages_are_aligned_too(spark):
    """Lines that marked pages share go by differencing; the place brings back those of the article."""
    page = lambda i: f"<nav><ul><li>Home</li><li>Only {i}</li></ul></nav><p>Site line</p><article><p>Story {i} is this.</p><p>Quoted by all.</p></article><footer>Terms</footer>"
    got = _site(spark, "m.example", [(f"/{i:02}", page(i)) for i in range(20)])
    assert all(r.text == f"Story {i} is this.\nQuoted by all." and r.n_shared == 3 for i, r in got.items())


def test_frames_go_inside_a_run_of_copies(spark):
    body = lambda story: f"<p>Menu of the site</p><p>{story}</p><p>Imprint</p>"
    stories = ["The first story is on its own here."] + ["A story that is printed many times over."] * 12 + ["The last story is on its own here."]
    # Not only equal pages: every other copy has a line of its own.
    pages = [(f"/{i:02}", body(s) + (f"<p>Seen {i}</p>" if i % 2 else "")) for i, s in enumerate(stories)]
    for some in (pages, pages[:-1], pages[1:]):
        got = _site(spark, "c.example", some)
        for i, (path, _) in enumerate(some):
            at = int(path[1:])
            assert got[i].text == stories[at] + (f"\nSeen {at}" if at % 2 else ""), (len(some), i)


def test_frames_of_more_than_half_a_page_go(spark):
    long = "A menu that has more words than any story of the site " * 3
    got = _site(spark, "s.example", [(f"/{i:02}", f"<p>{long}</p><p>Story {i}</p><p>Imprint</p>") for i in range(9)])
    assert all(r.text == f"Story {i}" and r.n_shared == 2 for i, r in got.items())
    alone = _site(spark, "t.example", [("/a", "<p>Same</p>"), ("/b", "<p>Same</p>")])  # copies only: no rest, nothing goes
    assert [alone[i].text for i in range(2)] == ["Same", "Same"]


def test_a_run_of_copies_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(html_extraction, "_BLOCK", 4)
    test_frames_go_inside_a_run_of_copies(spark)
