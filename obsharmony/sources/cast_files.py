"""Instrument text files: header, scans, binned cast table, file errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.text import extract_group, to_number
from ..operators import profiles
from ..operators.joins import null_safe_join
from ..operators.reshape import unpivot_long
from ..session import durable

# Sensor codes of the instrument maker for the sensors kept.
SENSORS = {
    "depth": ["depsm", "depfm", "deps", "depf"],
    "temperature": ["t090c", "t068c", "tv290c", "tv268c", "t190c"],
    "PAR": ["par"],
    "spar": ["spar"],
    "oxygen": ["sbeox0mg/l", "sbox0mg/l", "oxmg/l"],
    "specificConductance": ["specc"],
    "conductivity": ["c0s/m", "c0ms/cm", "c0us/cm", "c0ms/m"],
    "pH": ["ph"],
}
UNITS = {
    "temperature": "C", "oxygen": "mgl", "specificConductance": "uScm",
    "cpar": None, "pH": None,
}
END_MARK = r"^\*END\*"
BAD_VALUE = -9.99e-29


def _header_value(key: str) -> Column:
    """Text after '= ' or ': ' of the first header line holding `key`."""
    hit = F.col("line").rlike(rf"(?i)^[*#]+\s*{key}\s*[=:]")
    value = F.trim(F.regexp_replace(F.col("line"), r"^[^=:]*[=:]", ""))
    return F.min_by(F.when(hit, value), F.when(hit, F.col("line_no")))


def _degrees(c: str) -> Column:
    """Decimal degrees from 'DD MM.MM H' or a plain number."""
    shape = r"^\s*(\d+)\s+(\d+\.?\d*)\s*([NSEWnsew]?)"
    value = to_number(extract_group(c, shape, 1)) + to_number(extract_group(c, shape, 2)) / 60
    sign = F.when(F.upper(extract_group(c, shape, 3)).isin("S", "W"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.coalesce(value * sign, to_number(c))


def headers(lines: DataFrame) -> DataFrame:
    """One row per file: end of header, column codes in order, metadata.

    The start time is preferred over the date, as it carries the time of day.
    Only header lines are grouped, so the size of a file does not matter.
    """
    head = lines.filter(F.col("line").rlike(r"^\s*[*#]"))
    code = extract_group("line", r"^#\s*name\s+(\d+)\s*=\s*([^:]+):", 2)
    index = extract_group("line", r"^#\s*name\s+(\d+)\s*=", 1).cast("int")
    end = F.when(F.col("line").rlike(END_MARK), F.col("line_no"))
    out = head.groupBy("path").agg(
        F.min(end).alias("end_line"),
        F.sort_array(
            F.collect_list(F.when(index.isNotNull(), F.struct(index.alias("i"), F.lower(F.trim(code)).alias("c"))))
        ).alias("__names"),
        _header_value("start_time").alias("__start"),
        _header_value("date").alias("__date"),
        _header_value("(?:NMEA )?latitude").alias("__lat"),
        _header_value("(?:NMEA )?longitude").alias("__lon"),
        _header_value("(?:water )?depth").alias("__depth"),
    )
    return out.select(
        "path",
        "end_line",
        F.transform("__names", lambda n: n["c"]).alias("names"),
        F.coalesce(_time("__start"), _time("__date")).alias("sampleDateTime"),
        _degrees("__lat").alias("Latitude"),
        _degrees("__lon").alias("Longitude"),
        to_number("__depth").alias("stationDepth"),
    )


def _time(c: str) -> Column:
    """'Jul 19 2010 17:30:00' or '2010-07-19 17:30' to a time."""
    date = F.coalesce(
        times.parse_date(c, "mdy", time_may_follow=True), times.parse_date(c, "ymd", time_may_follow=True)
    )
    clock = F.coalesce(F.regexp_substr(F.col(c), F.lit(r"\d{1,2}:\d{2}(:\d{2})?")), F.lit("00:00"))
    return F.concat(date.cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def name_census(head: DataFrame) -> DataFrame:
    """How many files carry each sensor code."""
    return head.select("path", F.explode("names").alias("name")).groupBy("name").agg(
        F.count_distinct("path").alias("files")
    )


def file_errors(lines: DataFrame, head: DataFrame) -> DataFrame:
    """Files that cannot be read as casts, with the reason; nothing is raised."""
    files = lines.select("path").distinct()
    found = null_safe_join(files, head.select("path", "end_line", "names"), ["path"])
    depth = F.exists(
        F.coalesce("names", F.array().cast("array<string>")), lambda n: n.isin(SENSORS["depth"])
    )
    reason = (
        F.when(F.col("end_line").isNull(), F.lit("no end of header"))
        .when(~depth, F.lit("no depth column"))
    )
    return found.select("path", reason.alias("reason")).filter(F.col("reason").isNotNull())


def scans(lines: DataFrame, head: DataFrame) -> DataFrame:
    """Data lines as numbers, one column per sensor kept; bad values are NULL."""
    good = head.filter(F.col("end_line").isNotNull()).select("path", "end_line", "names")
    data = null_safe_join(lines, good, ["path"], "inner").filter(
        (F.col("line_no") > F.col("end_line")) & (F.trim("line") != "")
    )
    cells = F.split(F.trim("line"), r"\s+")

    def sensor(codes: list[str]) -> Column:
        place = F.coalesce(
            *[F.nullif(F.array_position("names", c), F.lit(0).cast("bigint")) for c in codes]
        )
        value = to_number(F.try_element_at(F.col("__cells"), place.cast("int")))
        return F.when(value != BAD_VALUE, value)

    data = data.withColumn("__cells", cells)
    return data.select(
        "path", F.col("line_no").alias("scan"), *[sensor(c).alias(s) for s, c in SENSORS.items()]
    ).filter(F.col("depth").isNotNull())


def cast_table(lines: DataFrame, despike_width: int = 3, despike_spread: float = 4.0) -> DataFrame:
    """Text lines (path, line_no, line) to the binned long cast table.

    Downcast, despike, percent light, surface scans out, 1 m bins, metadata, long.
    """
    head = durable(headers(lines))
    sensors = [s for s in SENSORS if s != "depth"]
    df = profiles.downcast(scans(lines, head), ["path"], "scan", "depth")
    df = profiles.despike(df, ["path"], "scan", sensors, despike_width, despike_spread)
    df = df.withColumn("cpar", F.try_divide("PAR", "spar"))
    df = profiles.usable_scans(df, "depth")
    df = profiles.metre_bins(df, ["path"], "depth", profiles.CAST_SENSORS)
    df = null_safe_join(df, head.drop("end_line", "names"), ["path"])
    ids = ["path", "depth", "sampleDateTime", "Latitude", "Longitude", "stationDepth"]
    long = unpivot_long(df, ids, profiles.CAST_SENSORS)
    unit = F.lit(None).cast("string")
    for name, text in UNITS.items():
        if text:
            unit = F.when(F.col("ANALYTE") == name, F.lit(text)).otherwise(unit)
    return long.withColumnsRenamed({"depth": "sampleDepth", "path": "STATION_ID"}).withColumn(
        "UNITS", unit
    )


def file_sites(paths: DataFrame, path: str, aliases: DataFrame) -> DataFrame:
    """Site and date of every listed file from its path; files at unlisted sites are dropped."""
    named = profiles.with_path_date(paths.withColumn("siteID", profiles.path_site(path)), path)
    table = aliases.filter(F.col("Keep") == "T").drop("Keep", "Justification")
    return named.join(table.withColumnRenamed("Other.names", "siteID"), "siteID")
