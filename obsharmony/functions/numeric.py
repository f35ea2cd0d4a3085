"""Numeric expressions: rounding, gamma curve, seeded uniform draw, conductance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


def ratio_percent(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole; NULL when the whole is zero."""
    return 100 * F.try_divide(as_col(part), as_col(whole))


def gamma_cdf(x: Column | str, shape: int, scale: float) -> Column:
    """Gamma distribution function for a whole-number shape, as a plain expression.

    F(x) = 1 - exp(-z) * sum(z^i / i!, i < shape) with z = x / scale, the sum in
    nested form; zero at and below zero.
    """
    z = as_col(x) / F.lit(float(scale))
    total = F.lit(1.0)
    for i in range(shape - 1, 0, -1):
        total = F.lit(1.0) + z * total / F.lit(float(i))
    return F.when(z <= 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.exp(-z) * total)


def gamma_profile(depth: Column | str, shape: int, scale: float) -> Column:
    """Model temperature at a depth: 22 degrees at the surface, 4 at the bottom."""
    return F.lit(22.0) - F.lit(18.0) * gamma_cdf(depth, shape, scale)


def seeded_uniform(seed: int, *keys: Column | str) -> Column:
    """Repeatable draw in (0, 1) from the row's own key, equal on every run and retry.

    The first 13 hexadecimal digits of the MD5 of seed and keys, spelled as text with '|' between
    them (a missing key as 'NA'), so that other engines can draw the same."""
    spelled = [F.coalesce(as_col(k).cast("string"), F.lit("NA")) for k in keys]
    digits = F.substring(F.md5(F.encode(F.concat_ws("|", F.lit(str(seed)), *spelled), "UTF-8")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**13))


def specific_conductance(c: Column | str, temperature: Column | str, coefficient: float) -> Column:
    """Conductivity (S/m) at a temperature to conductance at 25 degrees (uS/cm)."""
    return F.try_divide(
        as_col(c) * 10000.0, 1.0 + F.lit(float(coefficient)) * (as_col(temperature) - 25.0)
    )
