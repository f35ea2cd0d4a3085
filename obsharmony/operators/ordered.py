"""Ordered work inside groups of any size.

A window over a whole group would put that group into one task. Positions and carried values
work on ranges instead: rows are range-partitioned by group and order value, windows run inside
(group, range), and a summary of each range carries totals and last values to the next. Quantiles
are selected digit by digit: counts per leading digits of an order-preserving integer narrow the
interval of each rank, so a window never sees more rows than a digit has values. All
results are exact, and the plan is the same for groups of every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable
from .joins import null_safe_join

RANGE = "__range"
_DIGIT_BITS = 16
_KEY_BITS = 64


def with_ranges(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows with the number of their range; ranges ascend by group and order value.

    The ranges are materialised once, since a second sampling may cut elsewhere. Rows of
    one group and one order value share a range."""
    placed = df.repartitionByRange(*by, order).withColumn(RANGE, F.spark_partition_id())
    return durable(placed, "ranges")


def _before(by: list[str]):
    return W.partitionBy(*by).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)


def _up_to_here(by: list[str], order: str):
    return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)


def with_position(df: DataFrame, by: list[str], order: str, name: str = "position") -> DataFrame:
    """0-based position by `order` inside each group; `order` must be unique there."""
    cut = with_ranges(df, by, order)
    # A group has at most as many rows here as there are partitions.
    offsets = (
        cut.groupBy(*by, RANGE)
        .agg(F.count("*").alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(_before(by)), F.lit(0)))
        .drop("__n")
    )
    inside = F.count("*").over(_up_to_here([*by, RANGE], order))
    return (
        null_safe_join(cut, offsets, [*by, RANGE])
        .withColumn(name, F.col("__offset") + inside - 1)
        .drop(RANGE, "__offset")
    )


def carry_forward(df: DataFrame, by: list[str], order: str, column: str) -> DataFrame:
    """Replace NULL by the last known value before it; `order` must be unique in the group."""
    cut = with_ranges(df, by, order)
    known = F.when(F.col(column).isNotNull(), F.col(order))
    carried = (
        cut.groupBy(*by, RANGE)
        .agg(F.max_by(column, known).alias("__last"))
        .withColumn("__carry", F.last("__last", ignorenulls=True).over(_before(by)))
        .drop("__last")
    )
    here = F.last(column, ignorenulls=True).over(_up_to_here([*by, RANGE], order))
    return (
        null_safe_join(cut, carried, [*by, RANGE])
        .withColumn(column, F.coalesce(here, F.col("__carry")))
        .drop(RANGE, "__carry")
    )


def order_key(value: Column) -> Column:
    """Integer that sorts as the double does: exponent and mantissa of its size, and its sign.

    Zero has one key; infinity stands above all numbers and NaN above that. Every step is exact."""
    size, least = F.abs(value), -1022
    guess = F.greatest(F.floor(F.log2(size)), F.lit(least)).cast("int")
    two_to = lambda e: F.pow(F.lit(2.0), e)
    low = (guess > least) & (size < two_to(guess))
    exponent = F.when(low, guess - 1).when((guess < 1023) & (size >= two_to(guess + 1)), guess + 1).otherwise(guess)
    scaled = (size / two_to(exponent) * F.lit(2.0**52)).cast("long")
    key = (exponent - least).cast("long") * F.lit(1 << 52) + scaled
    key = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(key)
    return F.when(F.isnan(value), F.lit(0x7FF8 << 48)).when(value < 0, -key).otherwise(key)


def select_ranks(counts: DataFrame, by: list[str], value: str, ranks: DataFrame) -> DataFrame:
    """Values at 0-based ranks. counts: (by, value, __n, __key), values distinct; ranks: (by, __rank)."""
    left = durable(ranks.withColumns({"__head": F.lit(0).cast("long"), "__start": F.lit(0).cast("long")}), "ranks")
    for shift in range(_KEY_BITS - _DIGIT_BITS, -1, -_DIGIT_BITS):
        above = F.shiftright("__key", shift + _DIGIT_BITS)
        first = shift + _DIGIT_BITS == _KEY_BITS
        inside = counts.withColumn("__head", F.lit(0).cast("long") if first else above)
        if not first:
            inside = null_safe_join(inside, left.select(*by, "__head").distinct(), [*by, "__head"], "left_semi")
        digit = F.shiftright("__key", shift).alias("__next")
        sums = [F.sum("__n").alias("__n"), F.max(value).alias("__value")]
        found = inside.groupBy(*by, "__head", digit).agg(*sums)
        # No more rows to a window than a digit has values.
        ended = F.sum("__n").over(_up_to_here([*by, "__head"], "__next"))
        found = found.withColumn("__end", ended)
        met = null_safe_join(left, found, [*by, "__head"], "inner")
        at = F.col("__rank") - F.col("__start")
        met = met.filter((at >= F.col("__end") - F.col("__n")) & (at < F.col("__end")))
        left = met.select(
            *by, "__rank", F.col("__next").alias("__head"), (F.col("__start") + F.col("__end") - F.col("__n")).alias("__start"), "__value"
        )
        # Written, as two branches read it: a few rows a group, so that the optimizer broadcasts them.
        left = durable(left.drop("__value") if shift else left, "ranks")
    return left.select(*by, "__rank", F.col("__value").alias(value))


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of `probs`.

    Equal values are counted before any shuffle, so heavy repetition is cheap. Rows without a
    value do not count; a group without any value is not in the result.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    counts = durable(counts.withColumn("__key", order_key(F.col(value).cast("double"))), "counts")
    totals = durable(counts.groupBy(*by).agg(F.sum("__n").alias("__total")), "totals")
    place = {name: F.lit(float(p)) * (F.col("__total") - 1) for name, p in probs.items()}
    both = F.array_distinct(F.array(*[r for h in place.values() for r in (F.floor(h), F.ceil(h))]))
    ranks = totals.select(*by, F.explode(both).alias("__rank"))
    at = null_safe_join(select_ranks(counts, by, value, ranks), totals, by)
    lo = {n: F.max(F.when(F.col("__rank") == F.floor(h), F.col(value))) for n, h in place.items()}
    hi = {n: F.max(F.when(F.col("__rank") == F.ceil(h), F.col(value))) for n, h in place.items()}
    got = at.groupBy(*by).agg(
        F.max("__total").alias("__total"),
        *[c.alias(f"__lo_{n}") for n, c in lo.items()],
        *[c.alias(f"__hi_{n}") for n, c in hi.items()],
    )
    step = {n: (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * (h - F.floor(h)) for n, h in place.items()}
    return got.select(*by, *[(F.col(f"__lo_{n}") + s).alias(n) for n, s in step.items()])
