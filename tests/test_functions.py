"""Missing-value rules, text, times and numbers, one expectation per rule."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from obsharmony.functions import nulls, numeric, text, times
from obsharmony.operators.joins import natural_left_join, null_safe_join
from obsharmony.operators.reshape import union_by_name


def one(spark, *cols, **values):
    """Evaluate expressions over a single row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return list(row.select(*cols).first())


def test_null_matches_null(frame):
    left = frame("a string, x int", [("k", 1), (None, 2), ("z", 3)])
    right = frame("a string, y int", [("k", 10), (None, 20), (None, 21)])
    got = sorted((r.x, r.y) for r in null_safe_join(left, right, ["a"]).collect() if r.y)
    assert got == [(1, 10), (2, 20), (2, 21)]


def test_natural_join_checks_its_keys(frame):
    left, right = frame("a int, b int", [(1, 2)]), frame("a int, c int", [(1, 3)])
    assert natural_left_join(left, right, ["a"]).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="shared columns"):
        natural_left_join(left, right, ["a", "b"])
    with pytest.raises(ValueError, match="both sides"):
        null_safe_join(left.withColumn("c", F.lit(1)), right, ["a"])


def test_if_else_keeps_unknown(spark):
    x = F.lit(None).cast("int")
    assert one(spark, nulls.if_else(x > 1, F.lit("y"), F.lit("n")), F.when(x > 1, "y").otherwise("n")) == [None, "n"]


def test_negated_tests_keep_null_rows(frame):
    df = frame("s string", [("Remove",), ("x",), (None,)])
    assert df.filter(~nulls.matches("s", "remove", True)).count() == 2
    assert df.filter(~nulls.is_in("s", ["x"])).count() == 2
    assert df.filter(F.col("s") != "Remove").count() == 1


def test_paste_spells_missing(spark):
    none = F.lit(None).cast("string")
    assert one(spark, nulls.paste(F.lit("a"), none, sep="; "), nulls.na_text(none)) == ["a; NA", "NA"]


def test_numbers_from_text(spark):
    cases = {"5": 5.0, " 1e3 ": 1000.0, "abc": None, "1d": None, "0x1A": None, "7..5": None, "": None, "-.5": -0.5}
    assert one(spark, *[text.to_number(F.lit(k)) for k in cases]) == list(cases.values())
    assert one(spark, *[text.number_in_text(F.lit(k)) for k in ("<0.5", "1,234.5 x", "none")]) == [0.5, 1234.5, None]


def test_first_and_all_replacements(spark):
    assert one(spark, text.replace_first(F.lit("a/b/c"), "/"), text.remove_all(F.lit("a/b/c"), "/")) == ["ab/c", "abc"]
    assert one(spark, *text.split_once(F.lit("a_b_c"), "_"), *text.split_once(F.lit("a"), "_")) == ["a", "b_c", "a", None]
    assert one(spark, text.split_part(F.lit("a/b"), "/", -1), text.split_part(F.lit("a/b"), "/", 3)) == ["b", None]
    assert one(spark, text.base_name(F.lit(r"c:\x\y.cnv")), text.strip_extension(F.lit("y.b.cnv"))) == ["y.cnv", "y.b"]


@settings(max_examples=15, deadline=None)
@given(hs.dates(dt.date(1970, 1, 1), dt.date(2068, 12, 31)))
def test_date_orders_agree(spark, d):
    texts = {
        "mdy": f"{d.month}/{d.day}/{d.year}", "dmy": f"{d.day}-{d:%b}-{d.year}", "ymd": f"{d.year}.{d.month:02d}.{d.day:02d}",
    }
    assert one(spark, *[times.parse_date(F.lit(v), k) for k, v in texts.items()]) == [d] * 3
    short = f"{d.month}-{d.day}-{d.year % 100:02d}"
    assert one(spark, times.parse_date(F.lit(short), "mdy")) == [d]


def test_bad_dates_are_null(spark):
    bad = [("13/45/1999", "mdy"), ("2010-02-30", "ymd"), ("1997.12.03", "mdy"), ("2015-06-03 10:00", "ymd"), ("x", "dmy")]
    assert one(spark, *[times.parse_date(F.lit(s), o) for s, o in bad]) == [None] * 5


def test_zones_do_not_depend_on_the_session(spark):
    t = F.lit(dt.datetime(2020, 3, 8, 2, 30)).cast("timestamp_ntz")
    keep = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Chicago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            t = F.expr("TIMESTAMP_NTZ'2020-03-08 02:30:00'")
            utc, local, micros = one(
                spark, times.to_utc(t, times.zone_name(F.lit("EDT"))), times.local_date(t), times.epoch_micros(t)
            )
            assert utc == dt.datetime(2020, 3, 8, 6, 30) and local == dt.date(2020, 3, 7)
            assert micros == 1583634600 * 10**6
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)


def test_serial_numbers(spark):
    got = one(spark, times.serial_date(F.lit(42185.5)), times.serial_time(F.lit(42185.5)))
    assert got == [dt.date(2015, 6, 30), dt.datetime(2015, 6, 30, 12)]


def test_half_even_and_division(spark):
    assert one(spark, *[numeric.round_half_even(F.lit(x)) for x in (0.5, 1.5, 2.5)]) == [0.0, 2.0, 2.0]
    assert one(spark, numeric.ratio_percent(F.lit(1.0), F.lit(0.0)), numeric.ratio_percent(F.lit(1.0), F.lit(4.0))) == [None, 25.0]


@settings(max_examples=10, deadline=None)
@given(hs.floats(0.01, 80), hs.sampled_from([(10, 1.5), (10, 1.8), (9, 2.0), (6, 3.0)]))
def test_gamma_curve(spark, x, shape_scale):
    shape, scale = shape_scale
    n, z = 4000, x / scale
    step = z / n
    area = sum((step * (i + 0.5)) ** (shape - 1) * math.exp(-step * (i + 0.5)) for i in range(n)) * step
    assert one(spark, numeric.gamma_cdf(F.lit(x), shape, scale))[0] == pytest.approx(area / math.factorial(shape - 1), abs=1e-5)


def test_seeded_draw_is_repeatable_and_spread(spark):
    draws = [r[0] for r in spark.range(2000).select(numeric.seeded_uniform(3, "id")).collect()]
    again = [r[0] for r in spark.range(2000).repartition(5).select(numeric.seeded_uniform(3, "id"), "id").orderBy("id").collect()]
    assert draws == again and 0 < min(draws) < 0.01 and 0.99 < max(draws) < 1
    assert abs(sum(draws) / 2000 - 0.5) < 0.03


def test_union_checks_types(frame):
    with pytest.raises(TypeError, match="column a"):
        union_by_name(frame("a int", [(1,)]), frame("a string", [("x",)]))
    got = union_by_name(frame("a int, b int", [(1, 2)]), frame("a int, c int", [(3, 4)]))
    assert sorted(tuple(r) for r in got.fillna(0).collect()) == [(1, 2, 0), (3, 0, 4)]
