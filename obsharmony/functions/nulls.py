"""Column helpers for the missing-value rules the survey data relies on.

Spark's three-valued logic differs from the rules the harmonisation is defined
by; each helper states the rule it restores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice where an unknown condition gives NULL, not the second arm."""
    return F.when(cond, yes).when(~cond, no)


def matches(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Regex test that is FALSE for NULL text, so its negation keeps NULL rows."""
    p = f"(?i){pattern}" if ignore_case else pattern
    return F.coalesce(as_col(c).rlike(p), F.lit(False))


def is_in(c: Column | str, values) -> Column:
    """Membership test that is FALSE for NULL, so its negation keeps NULL rows."""
    return F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def na_text(c: Column | str) -> Column:
    """Text of a value with NULL spelled 'NA'."""
    return F.coalesce(as_col(c).cast("string"), F.lit("NA"))


def paste(*cols: Column | str, sep: str = "") -> Column:
    """Concatenate as text; NULL parts appear as 'NA' instead of vanishing."""
    return F.concat_ws(sep, *[na_text(c) for c in cols])


def blank_to_null(c: Column | str, *values: str) -> Column:
    """NULL for the empty text and any listed values."""
    c = as_col(c)
    return F.when(~c.isin("", *values), c)


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def finite(c: Column | str) -> Column:
    """NULL for NaN and both infinities."""
    c = as_col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def first_known(*cols: Column | str) -> Column:
    return F.coalesce(*[as_col(c) for c in cols])


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)
