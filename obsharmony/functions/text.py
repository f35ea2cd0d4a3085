"""Text helpers: first-match edits, splitting, path parts, unit text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col

# Plain decimal or exponent notation; hexadecimal and type-suffixed text is not a number.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    c = as_col(c).cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def number_in_text(c: Column | str) -> Column:
    """First number found inside a text, grouping commas ignored ('<1,200.5' -> 1200.5)."""
    digits = F.regexp_substr(
        F.regexp_replace(as_col(c), ",", ""), F.lit(r"[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?")
    )
    return digits.try_cast("double")


def replace_first(c: Column | str, pattern: str, replacement: str = "") -> Column:
    """Replace only the first match; `pattern` must not contain capture groups."""
    return F.regexp_replace(as_col(c), f"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def remove_all(c: Column | str, pattern: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, "")


def extract(c: Column | str, pattern: str) -> Column:
    """First match of a regex, NULL when there is none."""
    return F.regexp_substr(as_col(c), F.lit(pattern))


def extract_group(c: Column | str, pattern: str, group: int) -> Column:
    """A capture group, NULL when the pattern does not match."""
    c = as_col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def split_part(c: Column | str, sep: str, i: int) -> Column:
    """i-th piece (negative counts from the end), NULL when there is no such piece."""
    return F.try_element_at(F.split(as_col(c), sep), F.lit(i))


def split_once(c: Column | str, sep: str) -> tuple[Column, Column]:
    """Text before the first separator and the rest; the rest is NULL without one."""
    parts = F.split(as_col(c), sep, 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(as_col(c), r"[/\\]"), -1)


def strip_extension(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), r"\.[^.]*$", "")


def truncate_right(c: Column | str, width: int) -> Column:
    """Shorten to `width` characters, the last three being dots."""
    c = as_col(c)
    return F.when(
        F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))
    ).otherwise(c)


def unit_text(c: Column | str, remove_every_slash: bool = True) -> Column:
    """Lower-case unit text without '/', the spelling the conversion table uses."""
    c = as_col(c)
    return F.lower(remove_all(c, "/") if remove_every_slash else replace_first(c, "/"))


def site_key(c: Column | str) -> Column:
    """Lower-case site name without underscores."""
    return remove_all(F.lower(as_col(c)), "_")
