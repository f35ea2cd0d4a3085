"""Joins in which a missing key equals a missing key. How to join is the optimizer's choice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import all_of
from ..session import durable

KeyPair = str | tuple[str, str]


def _pairs(keys: Iterable[KeyPair]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Iterable[KeyPair], how: str = "left"
) -> DataFrame:
    """Equi-join where NULL matches NULL; the result keeps the left key names.

    Duplicate right keys fan out. Any other shared column name is an error, so
    a collision is always resolved by the caller.
    """
    pairs = _pairs(keys)
    clash = (set(left.columns) & set(right.columns)) - {r for _, r in pairs}
    clash |= {r for l, r in pairs if l != r and r in left.columns and r in right.columns} - {
        l for l, _ in pairs
    } - {r for _, r in pairs}
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    renamed = {r: f"__key_{i}" for i, (_, r) in enumerate(pairs)}
    right = right.withColumnsRenamed(renamed)
    cond = all_of(F.col(l).eqNullSafe(F.col(renamed[r])) for l, r in pairs)
    if how in ("left_semi", "left_anti"):
        return left.join(right, cond, how)
    out = left.join(right, cond, how)
    if how in ("full", "outer", "right"):
        out = out.withColumns({l: F.coalesce(F.col(l), F.col(renamed[r])) for l, r in pairs})
    return out.drop(*renamed.values())


def join_statistics(df: DataFrame, table: DataFrame, by: Iterable[KeyPair]) -> DataFrame:
    """Per-group statistics beside every row.

    The statistics are computed once and kept, so the optimizer knows their size: few
    groups are broadcast, and rows stay where they are; many are joined by a shuffle, in
    which adaptive execution splits hot keys.
    """
    return null_safe_join(df, durable(table, "statistics"), by)


def natural_left_join(left: DataFrame, right: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Left join on every shared column; the shared set must be the one the caller expects."""
    shared = [c for c in left.columns if c in right.columns]
    if set(shared) != set(expected):
        raise ValueError(f"shared columns {sorted(shared)}, expected {sorted(expected)}")
    return null_safe_join(left, right, shared)


def membership_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of each side are present in the other side."""
    a = left.select(F.col(key).alias("k")).distinct().withColumn("in_left", F.lit(1))
    b = right.select(F.col(key).alias("k")).distinct().withColumn("in_right", F.lit(1))
    both = F.col("in_left").isNotNull() & F.col("in_right").isNotNull()
    return null_safe_join(a, b, ["k"], "full").agg(
        F.count_if(F.col("in_left").isNotNull()).alias("left_keys"),
        F.count_if(F.col("in_right").isNotNull()).alias("right_keys"),
        F.count_if(both).alias("shared_keys"),
    )


def sql_literal(value) -> str:
    """A literal both Spark SQL and ANSI SQL read the same way."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def values_sql(rows, schema: str) -> str:
    """SELECT over inline rows; `schema` is 'name type, name type'."""
    cols = [c.strip().split() for c in schema.split(",")]
    names = ", ".join(n for n, _ in cols)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in cols)
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    return f"SELECT {casts} FROM (VALUES {body}) AS v({names})"


def inline_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Lookup table from literal rows."""
    raw = values_sql(rows, schema.replace("VARCHAR", "STRING"))
    # Regexes in the rows must reach the table unescaped.
    return spark.sql(raw.replace("\\", "\\\\"))


