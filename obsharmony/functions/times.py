"""Dates and times as expressions that do not depend on the session time zone.

Instants are TIMESTAMP_NTZ holding UTC. Parsing goes through ISO text and
try_cast, so bad text is NULL under ANSI mode and no zone is ever applied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col
from .text import to_number

# Fixed value: local time used for the final sample date (five hours behind UTC).
LOCAL_ZONE = "Etc/GMT+5"

# Zone abbreviations found in the lab database.
ZONE_NAMES = {"EST": "Etc/GMT+5", "EDT": "Etc/GMT+4", "CDT": "Etc/GMT+5"}

SERIAL_EPOCH = "1899-12-30"

_TOKENS = {"y": r"(\d{4}|\d{2})", "m": r"(\d{1,2}|[A-Za-z]{3,9})", "d": r"(\d{1,2})"}


def _month_number(token: Column) -> Column:
    names = F.lit("janfebmaraprmayjunjulaugsepoctnovdec")
    by_name = ((F.instr(names, F.lower(F.substring(token, 1, 3))) + 2) / 3).cast("int")
    return F.when(token.rlike("^[A-Za-z]"), by_name.cast("string")).otherwise(token)


def _full_year(token: Column) -> Column:
    two = F.length(token) == 2
    return F.when(
        two, F.concat(F.when(token > F.lit("68"), F.lit("19")).otherwise(F.lit("20")), token)
    ).otherwise(token)


def parse_date(c: Column | str, order: str, time_may_follow: bool = False) -> Column:
    """Date from text in 'ymd', 'mdy' or 'dmy' order; month names and 2-digit years allowed."""
    c = as_col(c)
    pattern = r"^\s*" + r"[^0-9A-Za-z]+".join(_TOKENS[part] for part in order)
    pattern += r"(?:\D|$)" if time_may_follow else r"\s*$"
    tokens = {part: F.regexp_extract(c, pattern, i + 1) for i, part in enumerate(order)}
    return calendar_date(tokens["y"], _month_number(tokens["m"]), tokens["d"])


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date from texts of digits, the year with two or four; NULL when there is no such day."""
    parts = [F.lpad(_full_year(year), 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")]
    return F.concat_ws("-", *parts).try_cast("date")


def day_of_year_date(day: Column, two_digit_year: Column) -> Column:
    """Date from a day number and a 2-digit year; NULL when the day is outside the year."""
    start = F.concat(_full_year(two_digit_year), F.lit("-01-01")).try_cast("date")
    shifted = F.date_add(start, day.try_cast("int") - 1)
    return F.when(F.year(shifted) == F.year(start), shifted)


def zone_name(c: Column | str) -> Column:
    """Abbreviation to fixed-offset zone name; other names are kept."""
    c = as_col(c)
    out = c
    for abbreviation, name in ZONE_NAMES.items():
        out = F.when(c == abbreviation, F.lit(name)).otherwise(out)
    return out


def to_utc(c: Column | str, zone: Column | str) -> Column:
    """Wall-clock time in `zone` to UTC."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(zone, F.lit("UTC"), as_col(c).cast("timestamp_ntz"))


def to_local(c: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(c).cast("timestamp_ntz"))


def local_date(c: Column | str) -> Column:
    """Calendar date of a UTC time in the reporting zone."""
    return to_local(c).cast("date")


def serial_date(c: Column | str) -> Column:
    """Spreadsheet day number to date."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.floor(as_col(c)).cast("int"))


def serial_time(c: Column | str) -> Column:
    """Spreadsheet day number with a day fraction to a time, whole seconds."""
    seconds = F.round(as_col(c) * 86400).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit(SERIAL_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds
    )


def at_time(date: Column, hour: Column, minute: Column) -> Column:
    """Date plus hour and minute; NULL when either is missing or out of range."""
    text = F.concat(
        date.cast("string"),
        F.lit(" "),
        F.lpad(hour.cast("int").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(minute.cast("int").cast("string"), 2, "0"),
        F.lit(":00"),
    )
    return text.try_cast("timestamp_ntz")


def decimal_hour(c: Column | str) -> tuple[Column, Column]:
    """Hour with a fraction (10.5) to whole hour and whole minute."""
    c = as_col(c)
    return F.floor(c), F.floor(60 * (c - F.floor(c)))


def clock_parts(c: Column | str) -> tuple[Column, Column]:
    """Hour and minute from either 'h:mm' text or a fraction of a day ('0.4375')."""
    c = as_col(c)
    number = to_number(c)
    hour, minute = decimal_hour(number * 24)
    by_text = r"^\s*(\d{1,2}):(\d{1,2})"
    return (
        F.coalesce(hour, F.when(c.rlike(by_text), F.regexp_extract(c, by_text, 1)).try_cast("bigint")),
        F.coalesce(minute, F.when(c.rlike(by_text), F.regexp_extract(c, by_text, 2)).try_cast("bigint")),
    )


def add_years(c: Column | str, years: int) -> Column:
    return as_col(c) + F.make_ym_interval(F.lit(years), F.lit(0))


def fix_century(c: Column | str, wrong_year: int = 1909, years: int = 100) -> Column:
    """Move times stamped in one wrong year to the right century."""
    c = as_col(c)
    return F.when(F.year(c) == wrong_year, add_years(c, years)).otherwise(c)


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, independent of the session zone."""
    c = as_col(c).cast("timestamp_ntz")
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    whole = (days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60) * 1_000_000
    return whole + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
