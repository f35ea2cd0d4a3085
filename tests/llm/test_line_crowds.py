"""A crowd of near copies of long lines: as brute force says, and met under keys only."""

from __future__ import annotations

import random

from obsharmony.llm import line_dedup
from obsharmony.llm.common import word_hashes


def test_crowd_of_long_lines_makes_no_pairs(spark):
    rng = random.Random(21)
    base, rows = [f"w{k}" for k in range(70)], []
    for i in range(120):
        w = list(base) if i % 3 else base[:25] + [f"x{i}-{k}" for k in range(45)]  # a common beginning alone is no copy
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice([[], [f"z{rng.randrange(9)}"]])
        rows.append((i, " ".join(w)))
    words = [word_hashes(t.encode().split()) for _, t in rows]
    want = {k for k, x in enumerate(words) if any(line_dedup.within(x, y, 2) for y in words[:k])}
    gone = line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), line_dedup.Lines(1, 4, 20, 50))
    assert "third#" not in gone._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id for r in gone.collect()} == want and 0 < len(want) < len(rows)
    assert max(map(len, words)) > 60
