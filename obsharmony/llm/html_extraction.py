"""Main text of web pages by differencing against the page with the nearest URL.

Pages of a host are put in the order of their URL paths; each is compared with its nearer
neighbour in that order. All text lines of both, marked ones too, are aligned by longest common
subsequence, and the lines both share are what the site prints on every page: they are deleted.
A neighbour that shares more than half of the page's own text is a copy of it and says nothing
about the site's frame: behind a run of copies, the pages on either side of the run are tried. Where
all share so much, the frame itself is that large, and the one that shares least is taken, if it
leaves a rest.

The place of a line is a check that follows: lines inside <article> or <main> come back even if the
neighbour has them too (articles quote and copy each other), and what stands in menus, footers,
adverts, forms and the like goes even if no neighbour has it, as does what stands beside a marked article.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept
from .html_lines import ARTICLE, OPEN, lines

#: A neighbour that shares more than this part of the page's characters is a copy.
COPY_SHARE = 0.5


def _row_bits(a: list, b: list) -> list[int]:
    """Bit vectors of the LCS of each beginning of a with b (zero bits count its length)."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, [full]
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _lengths(a: list, b: list) -> np.ndarray:
    """LCS length of a with each beginning of b; keeps one bit vector."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common_lines(a: list, b: list) -> list[int]:
    """Places in a of one longest common subsequence with b, in linear memory."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    out = list(range(first))
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    inner, other = a[first : len(a) - last], b[first : len(b) - last]
    if inner and other:
        if len(inner) * len(other) <= 1 << 22:
            rows, i, j = _row_bits(inner, other), len(inner), len(other)
            found = []
            while i and j:
                if inner[i - 1] == other[j - 1]:
                    i, j = i - 1, j - 1
                    found.append(first + i)
                elif _count(rows[i - 1], j) == _count(rows[i], j):
                    i -= 1
                else:
                    j -= 1
            out += reversed(found)
        else:
            half = len(inner) // 2
            ahead = _lengths(inner[:half], other)
            behind = _lengths(inner[half:][::-1], other[::-1])[::-1]
            cut = int(np.argmax(ahead + behind))
            out += [first + x for x in common_lines(inner[:half], other[:cut])]
            out += [first + half + x for x in common_lines(inner[half:], other[cut:])]
    return out + list(range(len(a) - last, len(a)))


def _count(v: int, j: int) -> int:
    return j - (v & ((1 << j) - 1)).bit_count()


def place(url: Column) -> tuple[Column, Column]:
    """Host (null without one) and path of a URL."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.nullif(host, F.lit("")), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _keys() -> dict[str, Column]:
    return {"__k1": F.xxhash64("page_id", "url", "html"), "__k2": F.xxhash64(F.lit(1), "html", "url", "page_id")}


def read_pages(pages: DataFrame) -> DataFrame:
    """Every row without its html: hashes of all its lines (`lines`), their lengths (`sizes`, 0 where the place
    of the line rules it out), `marked` for a page with an article, and the lines not ruled out (`texts`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes, sizes, marks = [], [], [], []
            for page in batch.column("html").to_pylist():
                found = lines(page)
                marked = any(kind == ARTICLE for _, kind in found)
                use = ARTICLE if marked else OPEN
                texts.append([t for t, kind in found if kind == use])
                hashes.append(np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) for t, _ in found], np.uint64).tobytes())
                sizes.append(np.array([len(t) if kind == use else 0 for t, kind in found], np.int32).tobytes())
                marks.append(marked)
            kept_columns = [batch.column(c) for c in names[:6]]
            made = [pa.array(hashes, pa.binary()), pa.array(sizes, pa.binary()), pa.array(marks, pa.bool_()), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept_columns, *made], names=names)

    names = ["page_id", "url", "__k1", "__k2", "host", "path", "lines", "sizes", "marked", "texts"]
    host, path = place(F.col("url"))
    rows = pages.withColumns(_keys() | {"host": host, "path": path}).select(*names[:6], "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, __k1 long, __k2 long, host string, path string, lines binary, sizes binary, marked boolean, texts array<string>"
    return rows.mapInArrow(run, schema)


#: What the alignment knows of a page.
_MARKS = ["host", "path", "lines", "sizes"]


def _numbered(rows: DataFrame, order: list[str], number: str, name: str) -> DataFrame:
    """Rows with their place in a global order, spread over many tasks whatever the order's values are.

    The place comes from row counts of the sorted partitions, one row each."""
    ranked = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), name)
    part = F.shiftright("__id", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranked.groupBy(part.alias("__part")).count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    at = ranked.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return at.withColumn(number, F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__start", "__id")


def signatures(read: DataFrame) -> DataFrame:
    """One row per different page that has a host, with its place `g` in the order of host and path."""
    marks = read.where(F.col("host").isNotNull()).select("__k1", "__k2", *_MARKS).dropDuplicates(["__k1", "__k2"])
    return _numbered(marks, ["host", "path", "__k1", "__k2"], "g", "pages")


def neighbours(marks: DataFrame) -> DataFrame:
    """Each signature with the pages of its host just before and after it (`others`)."""
    side = lambda name, step: marks.select((F.col("g") + step).alias("g"), F.struct(*_MARKS[:3]).alias(name))
    near = marks.join(side("previous", 1), "g", "left").join(side("next", -1), "g", "left")
    return near.withColumn("others", F.array("previous", "next")).drop("previous", "next")


#: Places in the order that share one copy of the pages beside their run.
_BLOCK = 1024


def beside_runs(marks: DataFrame, open_pages: DataFrame) -> DataFrame:
    """Open pages (those that both neighbours copy) with, as `others`, two pages on either side of their run.

    The page beside a run is a copy itself, whose other neighbour is none; the second is that one. A run of
    any length meets them in blocks, so that no task gets a run."""
    rows = _numbered(open_pages.select("g", "host"), ["g"], "__rank", "pages-open")
    key = ["host", "__run", "__block"]
    rows = rows.withColumns({"__run": F.col("g") - F.col("__rank"), "__block": F.floor(F.col("g") / _BLOCK)}).drop("__rank")
    blocks = rows.groupBy(*key).agg(F.min("g").alias("a"), F.max("g").alias("b"))
    ends = blocks.groupBy(*key[:2]).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    wanted = blocks.drop("a", "b").join(ends, key[:2]).select(*key, F.explode(F.expr("array(a - 1, a - 2, b + 1, b + 2)")).alias("g"))
    found = wanted.join(marks.select("g", F.struct(*_MARKS[:3]).alias("other")), "g").groupBy(*key).agg(F.collect_list("other").alias("others"))
    return marks.join(rows.drop("host"), "g").join(found, key, "left")


def _nearness(path: str, other: str) -> int:
    n = 0
    while n < min(len(path), len(other)) and path[n] == other[n]:
        n += 1
    return n


def shared_lines(near: DataFrame) -> DataFrame:
    """__k1, __k2, g, host, `shared`: places of the lines that a page shares with the nearest of its others
    that is no copy of it (none without others of its host; missing if all are copies); `least`: those
    shared with the copy that shares least, of those that leave a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, least = [], []
            for row in batch.to_pylist():
                own, sizes = np.frombuffer(row["lines"], np.uint64).tolist(), np.frombuffer(row["sizes"], np.int32)
                total, best = int(sizes.sum()), None
                found: list[int] | None = []
                others = [o for o in row["others"] or () if o and o["host"] == row["host"]]
                for other in sorted(others, key=lambda o: -_nearness(row["path"], o["path"])):
                    found = common_lines(own, np.frombuffer(other["lines"], np.uint64).tolist())
                    size = int(sizes[found].sum())
                    if size <= COPY_SHARE * total:
                        break
                    if size < total and (best is None or size < best[0]):
                        best = size, found
                    found = None
                shared.append(found)
                least.append(best and best[1])
            arrays = [batch.column(c) for c in names[:4]] + [pa.array(x, pa.list_(pa.int32())) for x in (shared, least)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["__k1", "__k2", "g", "host", "shared", "least"]
    return near.mapInArrow(run, "__k1 long, __k2 long, g long, host string, shared array<int>, least array<int>")


def differences(marks: DataFrame) -> DataFrame:
    """__k1, __k2, shared: places of the lines that differencing deletes from each page."""
    first = kept(shared_lines(neighbours(marks)), "pages-first")
    open_pages = first.where("shared IS NULL")
    second = shared_lines(beside_runs(marks, open_pages)).select("g", F.col("shared").alias("beyond"), F.col("least").alias("least_beyond"))
    # Without any page beside the run there is nothing beyond it.
    beyond = F.when(F.size("beyond") > 0, F.col("beyond"))
    smaller = F.when(F.size("least_beyond") < F.size("least"), F.col("least_beyond")).otherwise(F.coalesce("least", "least_beyond"))
    found = F.coalesce("shared", beyond, smaller, F.array().cast("array<int>"))
    return first.join(second, "g", "left").select("__k1", "__k2", found.alias("shared"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_shared (lines deleted as shared) of every page; repeated rows stay.

    Missing or empty html gives an empty text. A page without a URL or host has no neighbour, so
    nothing of it is deleted as shared. Markup may be broken or very long: it is read in linear time, a
    tag that never ends is text. Other columns of the input are not read; ties in the order of paths
    go by a hash of the whole row. An empty table gives no rows.
    """
    pages = pages.select("page_id", "url", "html")
    gone = differences(signatures(read_pages(pages)))
    # Texts are read again rather than written: they pass one shuffle and no table.
    joined = read_pages(pages).select("page_id", "url", "__k1", "__k2", "sizes", "marked", "texts").join(gone, ["__k1", "__k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for sizes, marked, stay, shared in zip(*(batch.column(c).to_pylist() for c in ("sizes", "marked", "texts", "shared"))):
                sizes, gone = np.frombuffer(sizes, np.int32), np.zeros(len(sizes) // 4, bool)
                gone[shared or []] = True
                if marked:  # the check by place: the article's own lines come back
                    gone &= sizes == 0
                texts.append("\n".join(t for t, out in zip(stay, gone[sizes > 0].tolist()) if not out))
                counts.append(int(gone.sum()))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_shared"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_shared long")
