"""Queries: dates, zones, serial numbers, file paths, scalar text and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric, text, times
from ..operators import profiles
from .catalog import observations, query, steady, steady_sql, table, with_obs

_ZONES = "CASE uid % 4 WHEN 0 THEN 'EST' WHEN 1 THEN 'EDT' WHEN 2 THEN 'CDT' ELSE 'GMT' END"


@query(
    with_obs(
        f"""SELECT uid, z AS TIME_ZONE, t + CASE z WHEN 'EST' THEN INTERVAL 5 HOUR WHEN 'CDT' THEN INTERVAL 5 HOUR
  WHEN 'EDT' THEN INTERVAL 4 HOUR ELSE INTERVAL 0 HOUR END AS utc, CAST(t - INTERVAL 5 HOUR AS DATE) AS local_date,
  CAST(hour(t) AS INTEGER) AS h, CAST(minute(t) AS INTEGER) AS m, CAST(year(t) AS INTEGER) AS y
FROM (SELECT uid, sampleDateTimeUTC AS t, {_ZONES} AS z FROM obs)"""
    )
)
def zone_local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("sampleDateTimeUTC")
    rows = observations(spark, sf_dir).select("uid", t, F.expr(_ZONES).alias("TIME_ZONE"))
    return rows.select(
        "uid",
        "TIME_ZONE",
        times.to_utc(t, times.zone_name("TIME_ZONE")).alias("utc"),
        times.local_date(t).alias("local_date"),
        F.hour(t).alias("h"),
        F.minute(t).alias("m"),
        F.year(t).alias("y"),
    )


@query(
    """SELECT o_orderkey, DATE '1899-12-30' + CAST(n AS INTEGER) AS d, TIMESTAMP '1899-12-30' + to_days(CAST(n AS INTEGER)) + to_seconds((o_orderkey % 24) * 3600) AS t
FROM (SELECT o_orderkey, date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS n FROM orders)"""
)
def serial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    serial = days.cast("double") + (F.col("o_orderkey") % 24) / F.lit(24.0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", times.serial_date(serial).alias("d"), times.serial_time(serial).alias("t")
    )


@query(
    """SELECT o_orderkey, CASE WHEN year(t) = 1909 THEN t + INTERVAL 100 YEAR ELSE t END AS t
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN make_timestamp(1909, month(o_orderdate), 1, 0, 0, 0.0) ELSE o_orderdate END AS t FROM orders)"""
)
def fix_century(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.concat(F.lit("1909-"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.lit("-01"))
    t = F.when(F.col("o_orderkey") % 3 == 0, wrong.cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", times.fix_century(t).alias("t"))


@query(
    with_obs(
        """SELECT uid, CAST(floor(d) AS BIGINT) AS h, CAST(floor(60 * (d - floor(d))) AS BIGINT) AS m,
  date_trunc('day', sampleDateTimeUTC) + to_seconds(CAST(floor(d) * 3600 + floor(60 * (d - floor(d))) * 60 AS BIGINT)) + INTERVAL 5 HOUR AS utc
FROM (SELECT uid, sampleDateTimeUTC, sampleDepth * 3 / 8e0 AS d FROM obs)"""
    )
)
def decimal_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour, minute = times.decimal_hour(F.col("sampleDepth") * 3 / F.lit(8.0))
    day = F.col("sampleDateTimeUTC").cast("date")
    at = times.to_utc(times.at_time(day, hour, minute), times.LOCAL_ZONE)
    return observations(spark, sf_dir).select(
        "uid", hour.alias("h"), minute.alias("m"), at.alias("utc")
    )


_CLOCKS = """CASE uid % 3 WHEN 0 THEN CAST(CAST(sampleDepth AS INT) % 24 AS STRING) || ':15'
  WHEN 1 THEN CAST(CAST(sampleDepth AS INT) % 16 / 16e0 AS STRING) ELSE 'noon' END"""


@query(
    with_obs(
        """SELECT uid, CASE uid % 3 WHEN 0 THEN CAST(sampleDepth AS BIGINT) % 24
   WHEN 1 THEN CAST(floor((CAST(sampleDepth AS BIGINT) % 16) / 16e0 * 24) AS BIGINT) END AS h,
  CASE uid % 3 WHEN 0 THEN 15 WHEN 1 THEN
   CAST(60 * ((CAST(sampleDepth AS BIGINT) % 16) / 16e0 * 24 - floor((CAST(sampleDepth AS BIGINT) % 16) / 16e0 * 24)) AS BIGINT) END AS m FROM obs"""
    )
)
def clock_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir).select("uid", F.expr(_CLOCKS).alias("time"))
    hour, minute = times.clock_parts("time")
    return rows.select("uid", hour.alias("h"), minute.alias("m"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN d WHEN 1 THEN d WHEN 2 THEN d WHEN 3 THEN d END AS parsed
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def parse_dates_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date").cast("string")
    y, m, day = (F.split(d, "-")[i] for i in range(3))
    month = F.substring(
        F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), m.cast("int") * 3 - 2, F.lit(3)
    )
    kind = F.col("o_orderkey") % 5
    raw = (
        F.when(kind == 0, F.concat_ws("/", m.cast("int").cast("string"), day.cast("int").cast("string"), y))
        .when(kind == 1, F.concat_ws("-", day, month, y))
        .when(kind == 2, F.concat_ws(".", y, m, day))
        .when(kind == 3, F.concat(y, F.lit("-"), m, F.lit("-"), day, F.lit(" 10:05")))
        .otherwise(F.lit("13/45/1999"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey",
        F.coalesce(
            times.parse_date("raw", "mdy"),
            times.parse_date("raw", "dmy"),
            times.parse_date("raw", "ymd", time_may_follow=True),
        ).alias("parsed"),
    )


# Cast paths in the spelling of each date pattern (in its order), of the last pass, and one without date.
_PATHS = """SELECT o_orderkey, o_orderdate, o_orderkey % 15 AS kind, CASE o_orderkey % 15
  WHEN 0 THEN '2010/' || doy || '-' || yy || ' cruise/raw/M45_' || o_custkey || '.cnv'
  WHEN 1 THEN '2010/' || m || '-' || d || '-' || yy || ' cruise/raw/muskegon.cnv'
  WHEN 2 THEN '2010/trip/raw/omega ' || doy || '-' || yy || '.cnv'
  WHEN 3 THEN '2010/trip/omega ' || month_name || d || '-' || yy || '.cnv'
  WHEN 4 THEN '2010/trip/raw/stationb_' || m || '_' || d || '_' || yy || '.cnv'
  WHEN 5 THEN '2010/trip/raw/omega ' || doy || '_' || yy || '.cnv'
  WHEN 6 THEN '2010/trip/' || doy || '-' || yy || '/muskegon.cnv'
  WHEN 7 THEN '2010/trip/' || m || '-' || d || '-' || yy || '/Alpha ' || o_custkey || '.CNV'
  WHEN 8 THEN '2010/trip/' || doy || '_' || yy || '/raw/muskegon.cnv'
  WHEN 9 THEN '2010/trip/raw/' || doy || '-' || yy || '/muskegon.cnv'
  WHEN 10 THEN '2010/trip/raw/' || m || '_' || d || '_' || yy || '/muskegon.cnv'
  WHEN 11 THEN '2010/trip/raw/' || m || '-' || d || '-' || yy || '/muskegon.cnv'
  WHEN 12 THEN '2010/trip/cnv/' || doy || '_' || yy || '/gh12.bin'
  WHEN 13 THEN '2010/trip/' || d || '-' || yy || '/' || m || '/muskegon.cnv'
  ELSE '2010/unknown/place.cnv' END AS path
FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, month(o_orderdate) AS m, day(o_orderdate) AS d,
  lpad(CAST(dayofyear(o_orderdate) AS STRING), 3, '0') AS doy, substr(CAST(year(o_orderdate) AS STRING), 3, 2) AS yy,
  CASE WHEN month(o_orderdate) = 6 THEN 'June' ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate) * 3 - 2, 3) END AS month_name
  FROM {orders})"""


# Kind 11 with a day of two digits meets the day-of-year pattern of its piece first: as day and
# year, or, with a month of two digits too, the month as the day and the day as the year.
@query(
    f"""WITH p AS ({_PATHS.format(orders='orders').replace('STRING', 'VARCHAR')})
SELECT o_orderkey, CASE WHEN kind = 14 THEN NULL
    WHEN kind = 11 AND day(o_orderdate) > 9 AND month(o_orderdate) > 9
    THEN make_date(2000 + day(o_orderdate), 1, 1) + CAST(month(o_orderdate) - 1 AS INTEGER)
    WHEN kind = 11 AND day(o_orderdate) > 9
    THEN CAST(date_trunc('year', o_orderdate) AS DATE) + CAST(day(o_orderdate) - 1 AS INTEGER) ELSE o_orderdate END AS sampleDate,
  CASE kind WHEN 0 THEN 'm45' WHEN 7 THEN 'alpha' WHEN 4 THEN 'stationb' WHEN 2 THEN 'omega' WHEN 3 THEN 'omega' WHEN 5 THEN 'omega'
            WHEN 12 THEN 'gh12' WHEN 14 THEN NULL ELSE 'muskegon' END AS siteID
FROM p"""
)
def path_site_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = spark.sql(_PATHS, orders=table(spark, sf_dir, "orders"))
    dated = profiles.with_path_date(paths, "path")
    return dated.select("o_orderkey", "sampleDate", profiles.path_site("path").alias("siteID"))


@query(
    """SELECT page_id, CASE WHEN regexp_matches(b, '[a-z]+[0-9]+|[0-9]+') THEN regexp_extract(b, '[a-z]+[0-9]+|[0-9]+') END AS site,
  regexp_replace(b, '\\.[^.]*$', '') AS base, nullif(split_part(url, '/', 4), '') AS piece, upper(trim(split_part(url, '/', 3))) AS host
FROM (SELECT page_id, url, array_extract(string_split_regex(url, '[/\\\\]'), -1) AS b FROM pages)"""
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = text.base_name("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.extract(base, "[a-z]+[0-9]+|[0-9]+").alias("site"),
        text.strip_extension(base).alias("base"),
        text.split_part("url", "/", 4).alias("piece"),
        F.upper(F.trim(text.split_part("url", "/", 3))).alias("host"),
    )


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]') THEN CAST(regexp_extract(replace(text, ',', ''), '[+-]?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?') AS DOUBLE) END AS first_number,
  regexp_replace(text, '\\s+', '') AS one_gap_less, regexp_replace(text, '\\s+', '', 'g') AS no_gaps,
  CASE WHEN length(text) > 7 THEN substr(text, 1, 4) || '...' ELSE text END AS short, lower(source) AS low
FROM documents"""
)
def text_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.number_in_text("text").alias("first_number"),
        text.replace_first("text", r"\s+").alias("one_gap_less"),
        text.remove_all("text", r"\s+").alias("no_gaps"),
        text.truncate_right("text", 7).alias("short"),
        F.lower("source").alias("low"),
    )


def _gamma_sql(x: str, shape: int, scale: str) -> str:
    total = "1e0"
    for i in range(shape - 1, 0, -1):
        total = f"(1e0 + ({x} / {scale}) * {total} / {i}e0)"
    return f"CASE WHEN {x} <= 0 THEN 0e0 ELSE 1e0 - exp(-({x} / {scale})) * {total} END"


@query(
    with_obs(
        f"""SELECT uid, {steady_sql(_gamma_sql('sampleDepth', 10, '1.5e0'))} AS g10,
  {steady_sql('22e0 - 18e0 * (' + _gamma_sql('sampleDepth', 10, '1.8e0') + ')')} AS p1,
  {steady_sql('22e0 - 18e0 * (' + _gamma_sql('sampleDepth', 9, '2e0') + ')')} AS p2,
  {steady_sql('22e0 - 18e0 * (' + _gamma_sql('sampleDepth', 6, '3e0') + ')')} AS p3,
  round_even(Latitude * 10, 0) AS lat_even, {steady_sql('sampleDepth * 10000 / (1e0 + 2e-2 * (RESULT - 25e0))')} AS conductance
FROM obs"""
    )
)
def profile_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    conductance = numeric.specific_conductance("sampleDepth", "RESULT", 0.02)
    return observations(spark, sf_dir).select(
        "uid",
        steady(numeric.gamma_cdf("sampleDepth", 10, 1.5)).alias("g10"),
        steady(numeric.gamma_profile("sampleDepth", 10, 1.8)).alias("p1"),
        steady(numeric.gamma_profile("sampleDepth", 9, 2.0)).alias("p2"),
        steady(numeric.gamma_profile("sampleDepth", 6, 3.0)).alias("p3"),
        numeric.round_half_even(F.col("Latitude") * 10).alias("lat_even"),
        steady(conductance).alias("conductance"),
    )
