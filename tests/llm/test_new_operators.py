"""Conversation repair, vector codes and chat trees against brute force, with the odd rows each must stand."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsharmony.llm import chat_tree, conversation_repair, vector_codes
from obsharmony.llm.conversation_repair import Costs, Repairer

CHAT = "conv_id long, turn long, role string, text string, label int, ids string, pack string, audit string"
_ORDER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def chats(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    said = ["ok.", "yes", "", " \t", "What is it? ", "fine!\n", "[INST] x </s>", "a\\b [\\INST] <\\\\s>", "<|endoftext|>", None, "世界 \U0001f600."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(9)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(said)))
    rows += [(500 + i, t, ("user", "assistant")[t % 2], f"shared {t}.") for i in range(30) for t in range(4)]
    rows += [(500 + i, 4 + t, ("user", "assistant")[t % 2], f"own {i % 7} {t}.") for i in range(30) for t in range(i % 3)]
    rows += [(900, 1, "user", "same row.")] * 300 + [(901, t, "user", "again.") for t in range(700)]
    rows += [(902, t, "assistant", f"n {t}") for t in range(900)] + [(903, 5, "user", "x" * 200_000 + " y" * 50_000)]
    rows += [(None, 1, "user", "no id."), (None, 2, "assistant", "none."), (None, None, None, None), (-4, 9_000_000_000, "user", "late.")]
    rng.shuffle(rows)
    return [(*r, 1, "i", "p", "a") for r in rows]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(chats(), CHAT).repartition(4).cache()


def ordered(rows, blank: str) -> dict:
    """Role and text by conversation, in the order that the operators state."""
    out = defaultdict(list)
    for c, t, role, text, *_ in rows:
        role, text = blank if role is None else role, blank if text is None else text
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        out[c].append(((t is not None, t or 0, role.encode(), digest), t, role, text))
    return {c: [r[1:] for r in sorted(rows, key=lambda r: r[0])] for c, rows in out.items()}


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Least (cost, edits) by trying all edits row by row; rows: initial, must go, truncated."""
    best = {0: (0, "")}

    def inserted(best):
        out = dict(best)
        for _ in range(3):
            for q, (c, a) in list(out.items()):
                r = 3 if q == 2 else 2
                out[r] = min(out.get(r, (1 << 60, "")), (c + 2, a + "I"))
        return out

    for initial, gone, cut in rows:
        new = {}
        for q, (c, a) in inserted(best).items():
            ways = [(q, c + 3, "D")]
            if not gone:
                ways.append((3 if q == 2 else 2, c + 2 + cut, "R"))
                if (q, initial) in _ORDER:
                    ways.append((_ORDER[q, initial], c + cut, "K"))
            for r, cost, e in ways:
                new[r] = min(new.get(r, (1 << 60, "")), (cost, a + e))
        best = new
    return min(v for q, v in inserted(best).items() if q in (0, 3))


def repaired(rows: list[tuple]) -> tuple:
    seen, counts, pairs, symbols = set(), [0, 0, 0], 0, []
    for _, role, text in rows:
        letters = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0 if not letters else 1 if (role, text) in seen else 2 if letters[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        symbols.append((role[:1], fault in (0, 1), fault == 2))
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, *_ in rows if t is not None}
    cost, audit = cheapest(symbols)
    left, q, it = [], 0, iter(rows)
    for e in audit:
        if e != "I":
            _, role, text = next(it)
        if e == "K":
            q = _ORDER[q, role[:1]]
        elif e != "D":
            q = 3 if q == 2 else 2
            role, text = {2: "user", 3: "assistant"}[q], "" if e == "I" else text
        if e != "D":
            left.append(f"{role}:{text}")
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *counts, pairs, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def test_repair_against_all_edits(table):
    hurt = conversation_repair.damaged(table)
    told, edited = conversation_repair.repair(hurt, present=table)
    by_hand = []
    for c, t, role, text, *_ in chats():
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        by_hand += [(c, t, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    rows = ordered(by_hand, " ")
    want = {c: repaired(rows.get(c, [])) for c in {r[0] for r in chats()}}
    got = {r[0]: tuple(r)[1:] for r in told.collect()}
    assert got == want
    left = defaultdict(list)
    for r in edited.orderBy("conv_id", "turn").collect():
        left[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(left[c]).encode()).hexdigest() == w[-1] for c, w in want.items())
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in rows)) for rows in left.values())


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], CHAT)
    told, edited = conversation_repair.repair(none)
    assert told.count() == edited.count() == 0
    some = spark.createDataFrame([(7, 0, "user", "gone.", 1, "i", "p", "a")], CHAT)
    told, _ = conversation_repair.repair(none, present=some)
    assert [tuple(r) for r in told.collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_runs_of_any_length():
    rng, repairer = random.Random(3), Repairer(Costs())
    symbols = [None, *((r, cut) for r in ("s", "u", "a", "") for cut in (False, True))]
    for _ in range(300):
        runs = [(s, rng.choice([1, 1, 2, 3, 5, 8, 40])) for s in rng.choices(symbols, k=rng.randrange(7))]
        rows = [((s or ("",))[0], s is None, bool(s and s[1])) for s, n in runs for _ in range(n)]
        assert repairer.audit(runs)[::-1] == cheapest(rows)
    audit, cost = repairer.audit([(("u", False), 1_000_000), (("a", True), 1_000_000)])
    assert len(audit.replace("I", "")) == 2_000_000 and cost == sum({"D": 3, "I": 2, "R": 2, "K": 0}[e] for e in audit) + sum(
        e != "D" for e in audit.replace("I", "")[1_000_000:]
    )


def vectors(seed: int, n: int, width: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    rows = [(i * 3, (centres[i % 9] + rng.normal(size=width) * rng.choice([0.01, 0.5])).astype(np.float32).tolist(), i % 4 or None, "x") for i in range(n)]
    rows += [rows[2]] * (40 if n > 5 else 2) + [(r[0] + 1, r[1], 2, "x") for r in rows[:30]]
    odd = [None, [None] * width, [float("nan")] * width, [float("inf")] * width, [0.0] * width, [1.0] * (width + 1), []]
    return rows + [(10_000 + i, v, 1, "x") for i, v in enumerate(odd)] + [(None, [0.5] * width, None, "x")]


def coded(rows: list[tuple], parts: int = 8, k: int = 16, rounds: int = 6) -> tuple[list[tuple], str]:
    """All distances of every round, in Python integers."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    q = sorted(((r[0] is None, r[0] or 0, [int(np.floor(4096 * np.float64(x))) for x in r[1]]), r[0], r[2]) for r in ok)
    width = len(q[0][0][2])
    q = [(v[2], i, label) for v, i, label in q if len(v[2]) == width]
    cuts = [p * width // parts for p in range(parts + 1)]
    split = [[np.array(v[cuts[p] : cuts[p + 1]], np.int64) for v, *_ in q] for p in range(parts)]
    books = [[x.copy() for x in s[:k]] for s in split]

    def took(p):
        return [min((int(((x - c) ** 2).sum()), e) for e, c in enumerate(books[p])) for x in split[p]]

    for _ in range(rounds):
        for p in range(parts):
            at = took(p)
            for e in range(len(books[p])):
                own = [x for x, (_, a) in zip(split[p], at, strict=True) if a == e]
                if own:
                    books[p][e] = np.array([int(s) // len(own) for s in np.sum(own, axis=0)], np.int64)
    last = [took(p) for p in range(parts)]
    out = [(i, label, "".join(f"{last[p][j][1]:02x}" for p in range(parts)), sum(last[p][j][0] for p in range(parts))) for j, (_, i, label) in enumerate(q)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e.tolist()).encode()).hexdigest()


@pytest.mark.parametrize("n, width", [(400, 16), (150, 19), (5, 8), (300, 3)])
def test_codes_against_all_distances(spark, n, width):
    rows = vectors(n, n, width)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string").repartition(3)
    got, found = vector_codes.encode(df)
    want, digest = coded(rows)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert found.sha256() == digest
    if n == 400:  # as the codebook comes to rest, ever fewer parts meet all entries
        assert found.looks[0][3] == sum(found.looks[0]) > 2 * found.looks[-1][3]
        assert found.looks[-1][0] > found.looks[1][0] and found.kept[-1] <= found.kept[0]


def test_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1, "x")]):
        got, found = vector_codes.encode(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string"))
        assert got.count() == 0 and found.sha256() == hashlib.sha256().hexdigest()


def test_bounds_never_hide_a_nearer_entry():
    rng = np.random.default_rng(1)
    points = rng.integers(-40, 40, (500, 4))
    book, near, bounds, b = rng.integers(-40, 40, (16, 4)), None, None, 8
    moved = np.zeros(16)
    for i in range(30):
        near, bounds, took = vector_codes.nearest_entries(points, book, moved, near, bounds, b)
        squares = ((points[:, None] - book) ** 2).sum(-1)
        assert (near[:, 0] == squares.argmin(1)).all()
        far = np.sqrt(np.take_along_axis(squares, near.astype(int), 1))
        assert (bounds[:, 0] >= far[:, 0]).all() and (bounds[:, 1 : near.shape[1]] <= far[:, 1:]).all()
        assert (np.diff(bounds[:, 1:], axis=1) >= 0).all()
        b = max(2, b - (i % 5 == 4))
        new = book + rng.integers(-1, 2, book.shape)
        moved, book = np.sqrt(((new - book) ** 2).sum(1)) * (1 + 1e-12), new


def test_escapes_come_back():
    rng = random.Random(2)
    bits = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "INST]", "s>", "/", "<|endoftext|>", "a", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(9)))
        safe = chat_tree.escaped(text)
        assert chat_tree.unescaped(safe) == text
        assert not any(c in safe for c in (*chat_tree.CONTROL, "<|endoftext|>"))


def test_trees_give_conversations_back(table):
    formatted = chat_tree.format_tree(table).cache()
    rows = ordered(chats(), "")
    packs = defaultdict(list)
    for r in formatted.collect():
        packs[r.pack].append(r)
    tokens = chat_tree.Tokens(chat_tree.tokenizer_path(), chat_tree.ranks_path())
    seen, emitted = {}, 0
    for pack in packs.values():
        pack.sort(key=lambda r: r.place)
        ids = np.frombuffer(b"".join(r.ids for r in pack if not r.ends), "<u4")
        emitted += len(ids)
        at, paths = 0, set()
        for r in pack:
            assert r.position == sum(s.end - s.start for s in r.attends) and r.start == at
            path = tuple(i for s in r.attends for i in ids[s.start : s.end].tolist())
            if r.ends:
                seen[r.conv_id] = tokens.text(np.array(path, np.uint32))
            else:
                at += r.n_ids
                whole = path + tuple(ids[r.start : at].tolist())
                if r.shared:  # once in a pack
                    assert whole not in paths
                    paths.add(whole)
    want = {c: "".join(f"[INST]{chat_tree.escaped(a)}[/INST]{chat_tree.escaped(b)}</s>" for _, a, b in turns) for c, turns in rows.items()}
    assert seen == want
    assert len({r.conv_id for p in packs.values() for r in p if not r.ends and r.shared and r.depth == 1}) < 30
    assert formatted.agg(chat_tree.sharing(formatted)).first()[0] > 1
    got = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(formatted).collect()}
    for c, turns in rows.items():
        loss = "".join(b for _, a, b in turns if a == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[c] == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)), len(loss), sha(loss), len(want[c]))


def test_trees_of_one_start_share_it(spark):
    rows = [(c, t, "user", f"turn {t} {c if t >= 3 else ''}", 1, "", "", "") for c in range(50) for t in range(5)]
    rows += [(c, t, "user", f"turn {t} {c if t >= 3 else ''}", 1, "", "", "") for c in (60, 61) for t in range(2)]
    df = spark.createDataFrame(rows, CHAT).repartition(5)
    got = chat_tree.format_tree(df).where(~F.col("ends")).groupBy("depth").count().collect()
    packs = chat_tree.format_tree(df).select("pack").distinct().count()
    counts = {r.depth: r["count"] for r in got}
    assert counts[4] == counts[5] == 50 and all(1 <= counts[d] <= packs for d in (1, 2, 3))


def test_tree_of_nothing(spark):
    none = chat_tree.format_tree(spark.createDataFrame([], CHAT))
    assert none.count() == 0 and chat_tree.read_back(none).count() == 0
