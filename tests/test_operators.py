"""Operators against brute force, with one group holding a large share of the rows."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from lookup_sheets import FLAGS
from pyspark.sql import functions as F

import __spark_entry__ as entry
from obsharmony.operators import cells, checks, flags, groups, impute, match, ordered, reshape
from obsharmony.operators import harmonize as hz

# --- flags ---------------------------------------------------------------------------

FLAG_ROWS = [
    (1, "a", "N", None, "nd", "N", "below", "Keep", None),
    (2, "a", None, "limit", "rl", "R", "below RL", "Keep", "x"),
    (3, "a", "H", "held", "hold", "H", "held long", None, None),
    (4, "b", "Q|Z", None, "q", "Q", "lab", "Keep", None),
    (5, "b", "Z", None, "z", None, None, "REMOVE it", None),
    (6, "b", "^E;", None, None, "E", "estimate", "Keep", None),
    (6, "b", "^E;", None, None, "E", "estimate", "Keep", None),
]
OBS = "id int, Study string, QAcode string, QAcomment string, RESULT double"
OBS_ROWS = [
    (1, "a", "ND", None, 1.0), (2, "a", "N, H", "held; over limit", 2.0), (3, "a", None, None, 3.0),
    (4, "b", "E", None, 4.0), (5, "b", "QE", "x", 5.0), (6, "b", "Z", None, 6.0), (7, "c", "N", None, 7.0),
    (8, "a", "NA; MDL", "NA; MDL", 8.0), (9, "a", "NA, X", None, 9.0), (10, None, "N", None, 1.0),
    (3, "a", None, None, 3.0), (1, "a", "ND", None, 1.0),
]
FIELDS = flags.FLAG_FIELDS


def by_hand(rows, table):
    """The flag contract, row by row."""
    out = []
    table = list(dict.fromkeys(table))
    for key, study, code, comment, result in rows:
        if code is None and comment is None:
            out.append((key, code, comment, *[None] * 5))
            continue
        code = code and re.sub("^NA; ", "", code.replace(",", ";"))
        comment = comment and re.sub("^NA; ", "", comment)
        c = re.sub(r"\s", "", code or "")
        c, m = (f"{c};XXXX" if c else "XXXX"), (f"{comment}; XXXX" if comment else "XXXX")
        hits = [f for f in table if f[1] == study and re.search(f[2] or "XXXX", c) and re.search(f[3] or "XXXX", m)]
        joined = []
        for i in range(4, 9):
            texts = list(dict.fromkeys("NA" if f[i] is None else f[i] for f in hits)) or ["NA"]
            text = ", ".join(texts)
            if i in (5, 6):
                text = None if text == "NA" else text.replace("NA, ", "").replace(", NA", "")
            joined.append(text)
        if "remove" not in joined[3].lower():
            out.append((key, code, comment, *joined))
    flagged = {r for r in out if (r[1], r[2]) != (None, None)}
    return sorted([*flagged, *[r for r in out if (r[1], r[2]) == (None, None)]], key=str)


def test_unify_flags(frame):
    got = flags.unify_flags(frame(OBS, OBS_ROWS), frame(FLAGS, FLAG_ROWS))
    rows = [tuple(r) for r in got.select("id", "QAcode", "QAcomment", *FIELDS).collect()]
    assert sorted(rows, key=str) == by_hand(OBS_ROWS, FLAG_ROWS)


def test_flag_order_comes_from_the_table_not_from_the_scan(frame):
    shuffled = FLAG_ROWS[:]
    random.Random(1).shuffle(shuffled)
    a = flags.unify_flags(frame(OBS, OBS_ROWS), frame(FLAGS, shuffled)).collect()
    b = flags.unify_flags(frame(OBS, OBS_ROWS), frame(FLAGS, FLAG_ROWS)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_limit_flags(frame):
    schema = "CodeName string, RESULT double, MDL double, RL double, QAcode string, QAcomment string"
    rows = [
        ("P", 1.0, 2.0, 3.0, None, "c"), ("P", 2.5, 2.0, 3.0, "A", None), ("P", 2.0, 2.0, None, None, None),
        ("P", None, 2.0, 3.0, "NA", None), ("CPAR", -1.0, None, None, None, None), ("CPAR", 101.0, None, None, "A", None),
        ("CPAR", None, None, None, "keep", None), ("P", 3.0, 2.0, 3.0, None, None), (None, 1.0, 2.0, None, None, None),
    ]
    got = [(r.RESULT, r.QAcode, r.QAcomment) for r in flags.limit_flags(frame(schema, rows)).collect()]
    assert got == [
        (1.0, "NA; MDL; RL", "c; MDL; RL"), (2.5, "A; RL; Estimated", "NA; RL; Estimated"), (2.0, None, None),
        (None, None, None), (0.0, None, None), (101.0, "A; PAR", "NA; Underwater PAR exceeds surface PAR"),
        (None, "keep", None), (3.0, "NA; Estimated", "NA; Estimated"), (1.0, "NA; MDL", "NA; MDL"),
    ]


def test_required_grams_are_in_every_match(frame):
    import re

    regexes = [
        "held too long", "U", "NA", "a.c", "colou?r", "ab*cd", "x{2}yz", "(opt)?must", "one|two", "[abc]def", "^start", "end$", r"d\.ot", r"\d+mg",
        "(?i)case", r"\x41b", "lazy*?tail", "a+b", "br[a(b]c(d]e)?", "", "XXXX",
    ]
    texts = ["held too long", "U;XXXX", "NA", "abc", "color", "colour", "acd", "abbcd", "xxyz", "must", "optmust", "one", "two", "bdef", "start", "end",
             "d.ot", "12mg", "CASE", "Ab", "laztail", "lazyytail", "aab", "bra(c", "brac", "brace", "XXXX", "held too long; XXXX"]
    got = {r.r: r.g for r in frame("r string", [(x,) for x in regexes]).select("r", flags.required_grams(F.col("r")).alias("g")).collect()}
    for r in regexes:
        for t in texts:
            try:
                hit = re.search(r, t)
            except re.error:
                hit = None
            if hit:
                assert all(g in t for g in got[r]), (r, t, got[r])
    assert "hel" in got["held too long"] and got["one|two"] == got["(?i)case"] == [] and got["U"] == ["U"]


def test_many_flags_meet_few_texts(spark, frame):
    """10,000 flags: a text meets only those whose rarest piece it holds, by an equi-join."""
    table = [("s", f"C{i:04d}", None if i % 2 else f"reason {i}", f"d{i}", "F", "c", None, "a", i) for i in range(10_000)]
    table += [("s", None, "everything", "all", "A", "c", None, "a", 10_000), ("s", "C00.1", None, "dot", "D", "c", None, "a", 10_001)]
    schema = "Study string, QAcode string, QAcomment string, Definition string, Unified_Flag string, Unified_Comment string, Retain string, Action string, flag_row int"
    texts = [("s", f"C{i:04d}", c) for i in range(0, 3000, 21) for c in (None, f"reason {i}", "everything else")] + [("t", "C0001", None)]
    matched = flags.match_vocabulary(frame("Study string, QAcode string, QAcomment string", texts), flags.prepare_flag_table(frame(schema, table)))
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {(r.Study, r.QAcode, r.QAcomment, r.flag_row) for r in matched.collect()}
    held = lambda regex, text: regex is None or regex in text or (regex == "C00.1" and text[:3] == "C00" and text[4] == "1")
    want = set()
    for s, c, m in texts:
        here = {f[8] for f in table if f[0] == s and held(f[1], c) and held(f[2], m or "")}
        want |= {(s, c, m, i) for i in here or {None}}
    assert got == want


def test_censor_priority(frame):
    df = frame("RESULT double, Unified_Flag string", [(1.0, f) for f in (None, "N", "N, E", "E, R", "R", "B, Q", "Q")])
    assert [r[0] for r in df.select(flags.censor()).collect()] == [1.0, None, None, 1.0, None, None, 1.0]


# --- ordered work and statistics with a hot group --------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": rng.permutation(n) * 3,
            "g": np.where(rng.random(n) < 0.4, "hot", [f"g{i % 9}" for i in range(n)]),
            "x": np.where(rng.random(n) < 0.3, np.nan, np.round(rng.lognormal(0, 2, n), 2)),
        }
    )
    pdf.loc[pdf.g == "g3", "g"] = None
    return pdf, spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def grouped(pdf):
    return pdf.assign(g=pdf.g.fillna("~")).sort_values("id").groupby("g")


def test_exact_quantiles(hot):
    pdf, df = hot
    probs = {"a": 0.0, "b": 0.025, "c": 0.5, "d": 0.975, "e": 1.0}
    got = {r.g or "~": [r[k] for k in probs] for r in ordered.quantiles(df, ["g"], "x", probs).collect()}
    want = {g: x.x.quantile(list(probs.values())).tolist() for g, x in grouped(pdf)}
    assert set(got) == set(want)
    assert all(np.allclose(got[g], want[g], rtol=1e-12) for g in want)


def test_order_key_sorts_as_doubles_do(frame):
    rng = np.random.default_rng(3)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, 5000).view(np.float64)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    near = [math.nextafter(2.0**e, x) for e in range(-1060, 1023, 7) for x in (0.0, math.inf)]
    values = [*map(float, bits), *odd, *near, *(2.0**e for e in range(-1074, 1024))]
    got = {repr(r.x + 0.0): r.k for r in frame("x double", [(x,) for x in values]).select("x", ordered.order_key(F.col("x")).alias("k")).collect()}
    known = sorted({x + 0.0 for x in values if not math.isnan(x)})
    keys = [got[repr(x)] for x in known]
    assert all(a < b for a, b in zip(keys, keys[1:])) and got["nan"] > keys[-1]


def test_quantiles_of_a_hot_group_of_near_values(spark):
    """Values that differ only in the last digits of their bits, in one group of most rows."""
    xs = [1.0 + (i * 7919 % 20_011) * 2.0**-52 for i in range(20_000)]
    rows = [("hot", x) for x in xs] + [("few", -3.5), ("few", 2.0), (None, 1e300), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {r.g: (r.low, r.mid, r.high) for r in ordered.quantiles(df, ["g"], "x", {"low": 0.0, "mid": 0.5, "high": 1.0}).collect()}
    xs.sort()
    assert got == {"hot": (xs[0], xs[9999] + (xs[10_000] - xs[9999]) * 0.5, xs[-1]), "few": (-3.5, -0.75, 2.0), None: (1e300,) * 3}


def test_position_and_carry_forward(hot):
    pdf, df = hot
    pos = {r.id: r.position for r in ordered.with_position(df, ["g"], "id").collect()}
    want = pd.concat([x.assign(p=range(len(x))) for _, x in grouped(pdf)])
    assert pos == dict(zip(want.id, want.p))
    carried = {r.id: r.x for r in ordered.carry_forward(df, ["g"], "id", "x").collect()}
    want = pd.concat([x.assign(f=x.x.ffill()) for _, x in grouped(pdf)])
    assert carried == {i: None if math.isnan(f) else f for i, f in zip(want.id, want.f)}


def test_group_fills_and_mode(hot, frame):
    pdf, df = hot
    filled = {r.id: r.x for r in groups.fill_group_mean(df, ["g"], ["x"]).collect()}
    want = pd.concat([x.assign(f=x.x.fillna(x.x.mean())) for _, x in grouped(pdf)])
    assert all(filled[i] == pytest.approx(f) for i, f in zip(want.id, want.f))
    df = frame("g int, u string", [(1, "b"), (1, "a"), (1, "none"), (2, "none"), (2, "none"), (2, "z"), (3, None), (3, "none")])
    got = sorted((r.g, r.u or "") for r in groups.fill_group_mode(df, ["g"], "u").collect())
    # ties go to the smallest value; a group that is mostly unknown stays unknown
    assert got == [(1, "a"), (1, "a"), (1, "b"), (2, "none"), (2, "none"), (2, "z"), (3, ""), (3, "none")]


def test_collapse_keeps_first_seen_order(frame):
    df = frame("g int, t string, o int", [(1, "b", 1), (1, None, 0), (1, "a", 2), (1, "b", 3), (2, None, 4)])
    got = {r.g: r.t for r in groups.collapse_texts(df, ["g"], ["t"], "o").collect()}
    assert got == {1: "NA, b, a", 2: "NA"}


# --- nearest match -----------------------------------------------------------------------


def curve(x):
    z = x / match.CURVE_SCALE
    total = 1.0
    for i in range(match.CURVE_SHAPE - 1, 0, -1):
        total = 1 + z * total / i
    return 0.0 if z <= 0 else 1 - math.exp(-z) * total


def nearest_by_hand(q, candidates, lim):
    window = match.DEEP_WINDOW if q["depth"] > 30 else match.SHALLOW_WINDOW
    best = None
    for c in candidates:
        if (
            abs(c["t"] - q["t"]) <= lim.micros
            and q["lat"] - lim.degrees <= c["lat"] <= q["lat"] + lim.degrees
            and q["depth"] - window <= c["depth"] <= q["depth"] + window
            and (lim.lon_degrees is None or q["lon"] - lim.lon_degrees <= c["lon"] <= q["lon"] + lim.lon_degrees)
        ):
            dlat, dlon = q["lat"] - c["lat"], q["lon"] - c["lon"]
            d = (
                (1 / lim.degrees) * math.sqrt(dlat * dlat + dlon * dlon)
                + (1 / window) * abs(curve(q["depth"]) - curve(c["depth"]))
                + (1 / lim.days) * (abs(q["t"] - c["t"]) / match.DAY_MICROS)
            )
            best = min(best, (d, c["id"])) if best else (d, c["id"])
    return best


@pytest.mark.parametrize("lon", [None, 0.02])
def test_nearest_match_equals_brute_force(spark, lon):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        if rng.random() < 0.5:  # one place and time holds half of all rows
            lat, lng, t = 43 + rng.random() * 1e-3, -86 + rng.random() * 1e-3, rng.randrange(3600)
        else:
            lat, lng, t = 42 + rng.randrange(40) * 0.01, -87 + rng.randrange(30) * 0.05, rng.randrange(12 * 86400)
        depth = float(rng.choice([0, 1, 5, 29, 30, 30.5, 35, 45, 60]))
        rows.append({"id": i, "lat": lat, "lon": lng, "t": t * 10**6, "depth": depth, "value": float(i)})
    asked, known = rows[:250], rows[250:]
    known += [{**known[0], "id": 9000, "value": -1.0}]  # same position: the smaller id stands
    lim = match.Limits(days=2, degrees=0.02, lon_degrees=lon, cell_rows=32)
    cols = ["lat", "lon", "t", "depth"]
    q = spark.createDataFrame(pd.DataFrame(asked)[cols])
    c = spark.createDataFrame(pd.DataFrame(known))
    got = {(r.q_lat, r.q_lon, r.q_t, r.q_depth): r.match_id for r in match.nearest_values(q, c, lim).collect()}
    want = {tuple(x[k] for k in cols): nearest_by_hand(x, known, lim) for x in asked}
    assert got == {k: v[1] for k, v in want.items() if v} and 0 < len(got) < len(want)


def test_nearest_match_shuffles_bounds_not_pairs(spark, monkeypatch):
    rng = random.Random(6)
    rows = [  # one crowded place: cells are cut finer more than once
        {"id": i, "lat": 43 + rng.random() * 5e-3, "lon": -86 + rng.random() * 5e-3, "t": rng.randrange(86400) * 10**6, "depth": rng.random() * 20, "value": float(i)}
        for i in range(1500)
    ]
    asked, known = rows[:60], rows[60:]
    kept, durable = [], match.durable
    monkeypatch.setattr(match, "durable", lambda df, *a: kept.append((df._jdf.queryExecution().optimizedPlan().toString(), durable(df, *a))) or kept[-1][1])
    lim = match.Limits(days=2, degrees=0.02, cell_rows=8)
    cols = ["lat", "lon", "t", "depth"]
    q, c = spark.createDataFrame(pd.DataFrame(asked)[cols]), spark.createDataFrame(pd.DataFrame(known))
    got = {(r.q_lat, r.q_lon, r.q_t, r.q_depth): r.match_id for r in match.nearest_values(q, c, lim).collect()}
    assert got == {tuple(x[k] for k in cols): nearest_by_hand(x, known, lim)[1] for x in asked}
    fronts = [(plan, df) for plan, df in kept if "level" in df.columns]
    # A window over a query's pairs had every pair of a query and a cell shuffled before any was dropped.
    assert len(fronts) >= 2 and not any("Window" in plan for plan, _ in fronts)
    # Bounds are known from the first level on, and go down.
    worst = [df.agg(F.max("best"), F.count_if(F.col("best").isNull()), F.count_if(F.col("low") > F.col("best"))).first() for _, df in fronts]
    assert all(w[1] == w[2] == 0 for w in worst) and worst[-1][0] <= worst[0][0]


def test_fill_nearest_edges(frame):
    t = dt.datetime(2020, 1, 1)
    schema = "id int, Latitude double, Longitude double, sampleDateTimeUTC timestamp_ntz, sampleDepth double, Temp double, Chla double"
    rows = [
        (1, 43.0, -86.0, t, 10.0, None, 1.0),
        (2, 43.0, -86.0, t + dt.timedelta(days=6), 10.0, 7.0, None),  # exactly on the time edge
        (3, 43.5, -86.0, t, 10.0, None, 1.0),  # nothing near
        (4, 43.0, -86.0, t, 10.0, None, None),  # outcome unknown: left alone
        (5, None, -86.0, t, 10.0, None, 1.0),  # no position
        (6, 43.0, -86.0, t + dt.timedelta(days=-6), 10.0, 9.0, None),  # as far as row 2, larger id
        (7, 43.0, -86.0, t, 15.1, 1.0, None),  # outside the depth window
    ]
    got = {r.id: r.Temp for r in match.fill_nearest(frame(schema, rows), "Temp", "Chla", "id").collect()}
    assert got == {1: 7.0, 2: 7.0, 3: None, 4: None, 5: None, 6: 9.0, 7: 1.0}


# --- imputation ----------------------------------------------------------------------------

LONG = (
    "uid int, Study string, Latitude double, Longitude double, sampleDateTimeUTC timestamp_ntz, CodeName string, sampleDepth double, "
    "RESULT double, MDL double, RL double, Unified_Flag string, Unified_Comment string"
)


def long_rows():
    t = dt.datetime(2020, 5, 1)

    def row(i, depth, result, mdl, rl, flag, code="P"):
        return (i, "s", 43.0, -86.0, t, code, depth, result, mdl, rl, flag, None)

    return [
        row(1, 1.0, 2.0, None, None, None), row(2, 1.0, 4.0, None, None, None),  # one position: mean 3
        row(3, 2.0, None, 8.0, None, "N"), row(4, 3.0, None, None, 9.0, None), row(5, 4.0, 1.5, None, None, "E"),
        row(6, 1.0, None, None, 6.0, None, "Q"), row(7, 1.0, None, None, None, "N", "R"),
    ]


@pytest.mark.parametrize(("method", "factor"), [("halfMDL", 0.5), (None, 1.0)])
def test_detection_limit_fill(frame, method, factor):
    out = impute.detection_limit_fill(frame(LONG, long_rows()), "uid", method)
    got = {(r.CodeName, r.sampleDepth): r.RESULT for r in out.collect()}
    assert got == {
        ("P", 1.0): 3.0, ("P", 2.0): 1.5 * factor,  # flagged: least of limits and results
        ("P", 3.0): 8.0 * factor,  # not flagged: the mean MDL of study, year and code
        ("P", 4.0): 1.5, ("Q", 1.0): 6.0 * factor, ("R", 1.0): None,
    }


def test_uniform_fill_draws_below_the_limit(frame):
    rows = [(i, "s", 43.0, -86.0, dt.datetime(2020, 5, 1), "P", float(i), None, 8.0, None, "N", None) for i in range(50)]
    draws = [[r.RESULT for r in impute.detection_limit_fill(frame(LONG, rows), "uid", "uniform", 4).orderBy("sampleDepth").collect()] for _ in range(2)]
    assert draws[0] == draws[1] and len(set(draws[0])) == 50 and all(0 < d < 8 for d in draws[0])


def test_forest_keeps_observed_values(spark):
    rng = np.random.default_rng(1)
    a = rng.random(400)
    pdf = pd.DataFrame({"id": range(400), "a": a, "b": a * 10, "c": rng.random(400)})
    df = spark.createDataFrame(pdf).withColumn("b", F.when(F.col("id") % 4 > 0, F.col("b")))
    df = df.withColumn("none", F.lit(None).cast("double"))
    out = impute.forest_fill(df, ["a", "b", "c", "none"], rounds=1, trees=10, depth=6).toPandas().set_index("id").sort_index()
    hidden = out.index % 4 == 0
    assert len(out) == 400 and out.none.isna().all()
    assert np.allclose(out.b[~hidden], pdf.b[~hidden]) and out.b.notna().all()
    assert (out.b[hidden] - pdf.b[hidden].to_numpy()).abs().mean() < 1.0
    assert impute.low_missing_columns(df, ["a", "b", "c"], "b", 0.9) == ["a", "c"]


def test_forest_error_is_that_of_unseen_rows(spark):
    rng = np.random.default_rng(4)
    a, noise = rng.random(1500), rng.random(1500)
    pdf = pd.DataFrame({"id": range(1500), "a": a, "b": a * 10, "c": noise, "full": rng.random(1500)})
    df = spark.createDataFrame(pdf)
    holed = df.withColumn("b", F.when(F.col("id") % 4 > 0, F.col("b"))).withColumn("c", F.when(F.col("id") % 3 > 0, F.col("c")))
    got = {r.variable: r for r in impute.forest_error(holed, df, ["a", "b", "c", "full"], ["id"], trees=10, depth=6).collect()}
    assert set(got) == {"b", "c"} and got["b"].n == 1125 and got["c"].n == 1000
    # The first follows from another column; noise cannot be told from rows that the trees have not seen.
    assert got["b"].nrmse < 0.6 and 0.9 < got["c"].nrmse < 1.3
    assert got["c"].mse == pytest.approx(got["c"].nrmse ** 2 * pdf.c[pdf.id % 3 > 0].var(ddof=0))
    assert impute.forest_error(df, df, ["a", "b"], ["id"]).collect() == []


def test_forest_query_runs_to_its_stop_rule(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    fits, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, df: fits.append((self.getNumTrees(), self.getMaxDepth())) or fit(self, df))
    rows = entry.queries()["forest_fill"](spark, "/root/testdata/sf0.001").toPandas()
    assert set(fits) == {(20, 8)} and 4 <= len(fits) <= 20 and len(fits) % 2 == 0
    raw = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").toPandas()
    assert len(rows) == len(raw) and not rows.isna().any().any()
    for c, seen in (("l_extendedprice", raw.l_partkey % 5 > 0), ("l_discount", raw.l_suppkey % 7 > 0)):
        whole = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", c]
        assert not Counter(raw.loc[seen, whole].itertuples(index=False, name=None)) - Counter(rows[whole].itertuples(index=False, name=None))
        assert rows[c].between(raw.loc[seen, c].min(), raw.loc[seen, c].max()).all()


def jobs_of(spark, run):
    """What run() returns, and how many Spark jobs it took."""
    group = f"forest-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def holed_table(spark, n=3000):
    rng = np.random.default_rng(8)
    a, b = rng.random(n), rng.integers(0, 4, n)
    pdf = pd.DataFrame({"id": range(n), "a": a, "b": b.astype(float), "c": 5 * a + b})
    df = spark.createDataFrame(pdf)
    holed = df.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a"))).withColumn("c", F.when(F.col("id") % 3 > 0, F.col("c")))
    return pdf, df, holed.withColumn("whole", F.lit("x"))


def test_forest_rounds_read_no_rows(spark, monkeypatch):
    pdf, _, holed = holed_table(spark)
    fits, fit = [], cells.CellForest._fit
    monkeypatch.setattr(cells.CellForest, "_fit", lambda self, x: fits.append(len(x[0])) or fit(self, x))
    (out, jobs) = jobs_of(spark, lambda: impute.forest_fill(holed, ["a", "b", "c"], depth=6).toPandas())
    # Over rows, each fit alone took a job for every level of the trees.
    assert len(fits) >= 4 and jobs <= 20
    out = out.sort_values("id").reset_index(drop=True)
    assert list(out.columns) == ["id", "a", "b", "c", "whole"] and len(out) == 3000 and not out.isna().any().any()
    for c, gap in (("a", pdf.id % 5 == 0), ("c", pdf.id % 3 == 0)):
        assert (out[c][~gap] == pdf[c][~gap]).all() and (out[c][gap] - pdf[c][gap]).abs().mean() < 0.6 * (pdf[c] - pdf[c].mean()).abs().mean()
    # Too many cells: the forests see rows, with much the same outcome.
    monkeypatch.setattr(cells, "MOST_CELLS", 0)
    rows = impute.forest_fill(holed, ["a", "b", "c"], rounds=2, depth=6).toPandas().sort_values("id").reset_index(drop=True)
    assert list(rows.columns) == list(out.columns) and not rows.isna().any().any()
    assert (rows.c - out.c).abs().mean() < 0.3


def test_forest_error_reads_rows_once(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(2000), "a": rng.integers(0, 2, 2000).astype(float)})
    pdf["b"] = 5 * pdf.a + 1000
    df = spark.createDataFrame(pdf)
    holed = df.withColumn("b", F.when(F.col("id") % 4 > 0, F.col("b")))
    got, jobs = jobs_of(spark, lambda: impute.forest_error(holed, df, ["a", "b"], ["id"]).collect())
    # Five fits of several jobs each, before. The one input tells the value, so nothing is left of the error.
    assert jobs <= 15 and [(r.variable, r.n) for r in got] == [("b", 1500)] and 0 <= got[0].mse + 1e-9 < 2e-9
    # Without a split the error is that of the mean of the other parts.
    flat = impute.forest_error(holed, df, ["a", "b"], ["id"], depth=0).collect()[0]
    assert flat.mse == pytest.approx(pdf.b[pdf.id % 4 > 0].var(ddof=0), rel=0.02) and flat.nrmse == pytest.approx(1, rel=0.02)


def test_cells_hold_what_rows_hold(spark):
    _, _, holed = holed_table(spark)
    cuts = cells.cuts_of(holed, ["a", "b", "c"])
    assert len(cuts["a"]) == 31 and cuts["b"].tolist() == [0.5, 1.5, 2.5]
    space = cells.Space(cuts, ["a", "c"])
    pdf = holed.select("a", "b", "c").toPandas()
    codes = space.codes([pdf[c].to_numpy() for c in space.columns])
    assert (codes[0][pdf.a.isna()] == 32).all() and np.bincount(codes[0][pdf.a.notna()]).min() > 50
    assert (space.decoded(space.keys(codes)) == np.stack(codes, 1)).all()

    def tally(v):
        c = space.codes([v[x] for x in space.columns])
        yield 7, space.keys(c), [np.ones(len(c[0])), v["b"]]

    keys, sums = cells.cells_of(cells.tallied(holed, space.columns, tally, 2), 7)
    want = pdf.assign(k=space.keys(codes), n=1.0).groupby("k")[["n", "b"]].sum()
    assert keys.tolist() == want.index.tolist() and np.allclose(sums, want.to_numpy())
    drawn = cells.draws(np.random.default_rng(1).integers(0, 2**63, 40000), 10, 1).astype(float)
    assert np.allclose(drawn.mean(0), 1, atol=0.03) and np.allclose(drawn.var(0), 1, atol=0.05)
    assert np.abs(np.corrcoef(drawn.T) - np.eye(10)).max() < 0.03
    with pytest.raises(ValueError):
        cells.cuts_of(spark.createDataFrame([(float("nan"),), (1.0,)], "a double"), ["a"])


# --- harmonisation and reshaping ----------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(hs.lists(hs.tuples(hs.integers(0, 5), hs.floats(-9, 9), hs.floats(-9, 9)), min_size=1, max_size=8, unique_by=lambda r: r[0]))
def test_unpivot_then_pivot_is_identity(frame, rows):
    df = frame("k int, a double, b double", rows)
    wide = reshape.pivot_wide(reshape.unpivot_long(df, ["k"], ["a", "b"]), ["k"], ["a", "b"], ["ANALYTE"])
    assert sorted(tuple(r) for r in wide.select("k", "a", "b").collect()) == sorted((k, a + 0.0, b + 0.0) for k, a, b in rows)


def test_convert_and_back(frame):
    table = hz.prepare_conversions(frame("ReportedUnits string, TargetUnits string, ConversionFactor string", [("a", "b", "8"), ("b", "a", "0.125"), ("a", "b", "8")]))
    df = frame("ReportedUnits string, TargetUnits string, RESULT double", [("a", "b", 3.0), ("a", "c", 3.0), ("a", "b", None)])
    once = hz.convert_units(df, table).drop("ConversionFactor")
    back = once.select(F.col("TargetUnits").alias("ReportedUnits"), F.col("ReportedUnits").alias("TargetUnits"), "RESULT")
    assert [r.RESULT for r in once.collect()] == [24.0, 3.0, None]
    assert [r.RESULT for r in hz.convert_units(back, table).collect()] == [3.0, 3.0, None]


def test_corrections_apply_in_order(frame):
    df = frame("s string, d double", [("a", 1.0), ("b", 2.0), (None, 3.0)])
    rules = [hz.Correction(F.col("s") == "a", {"s": "b", "d": 9.0}), hz.Correction(F.col("d") == 9, {"d": 10.0})]
    assert [tuple(r) for r in hz.apply_corrections(df, rules).collect()] == [("b", 10.0), ("b", 2.0), (None, 3.0)]


def test_first_row_per_key_and_distinct_means(frame):
    df = frame("k string, o int, v string", [("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")])
    got = groups.first_per_key(df, ["k"], ["o"]).collect()
    assert sorted((r.k or "", r.o, r.v) for r in got) == [("", 3, "z"), ("a", 1, "y")]
    df = frame("s string, y int, d int, x double", [("a", 1, 1, 4.0), ("a", 1, 1, 4.0), ("a", 1, 2, 8.0), ("a", 1, 3, None)])
    assert groups.mean_of_distinct(df, ["s"], "x", ["d"], "m").first().m == 6.0


def test_require_counts_violations(frame):
    df = frame("x int", [(1,), (None,), (3,)])
    checks.require(df, F.col("x").isNull() & F.lit(False), "fine")
    with pytest.raises(ValueError, match=r"bad \(2 rows\)"):
        checks.require(df, F.col("x") > 2, "bad")


def test_flag_vocabulary(frame):
    rows = [("s", "A;B,C", "x; y"), ("s", None, "No reported units"), ("s", "NA", "NA")]
    got = {tuple(r) for r in flags.flag_vocabulary(frame("Study string, QAcode string, QAcomment string", rows)).collect()}
    assert ("s", "U", "No reported units") in got and ("s", "C", "y") in got and len(got) == 7
