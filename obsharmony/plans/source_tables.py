"""Queries: each source pipeline on a source-shaped table derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import cast_files, casts, coastal, lab_database, workbook
from ..sources import standard as st
from .catalog import query, steady, steady_sql, table
from .harmonisation import _LIMIT_NAMES, _SEASON_SHEET
from .lookups import lookup, lookup_sql

_VARCHAR = ("STRING", "VARCHAR")

KEY = (
    "CodeName VARCHAR, Units VARCHAR, LongName VARCHAR, Category VARCHAR, Explicit_Units VARCHAR",
    [
        ("Tot_P", "ug/L", "Phosphorus, unfiltered", "Nutrients_Algae", "ug/L"),
        ("Chla", "ug/L", "Chlorophyll-a", "Nutrients_Algae", "ug/L"),
        ("SRP", "ug/L", "Soluble reactive phosphorus (orthophosphate)", "Nutrients_Algae", "ug/L"),
        ("CPAR", "percent", "PAR", "Chemical_Physical", "percent"),
        ("Turb_NTU", "NTU", "Turbidity", "Clarity_Carbon", "NTU"),
        ("pH", "unitless", "pH", "Chemical_Physical", "unitless"),
        ("Diss_SiO2", "mg/L", "Silica, dissolved", "Nutrients_Algae", "mg/L"),
        ("Temp", "C", "Temperature", "Chemical_Physical", "C"),
        ("Secchi", "m", "Secchi Disc Transparency", "Clarity_Carbon", "m"),
        ("Diss_NOx", "ug/L", "Oxidized nitrogen", "Nutrients_Algae", "ug/L"),
    ],
)
CONVERSIONS = (
    "ReportedUnits VARCHAR, TargetUnits VARCHAR, ConversionFactor VARCHAR",
    [("mgl", "ugl", "1000"), ("mgl", "ugl", "1000"), ("ugl", "mgl", "0.001")],
)
_NAME_SCHEMA = (
    "Study VARCHAR, ANALYTE VARCHAR, ANL_CODE VARCHAR, Methods VARCHAR, MEDIUM VARCHAR, "
    "FRACTION VARCHAR, CodeName VARCHAR, Units VARCHAR"
)


def _names(study: str, pairs: dict[str, str]) -> list[tuple]:
    return [(study, a, None, None, None, None, c, "x") for a, c in pairs.items()]


_LAB_CODES = {"click": "Tot_P", "view": "Chla", "purchase": "CPAR", "error": "Turb_NTU", "signup": "SRP"}
LAB_NAMES = (
    _NAME_SCHEMA,
    [
        (st.LAB_DATABASE, a, None, m, "water", f, "REMOVE" if (a, m) == ("signup", "M1") else c, "x")
        for a, c in _LAB_CODES.items()
        for m in (None, "M1", "M2")
        for f in (None, "Total")
        if (a, m) != ("error", "M2")
    ]
    + [
        (st.LAB_DATABASE, "pH", None, None, "water", None, "pH", "x"),
        (st.LAB_DATABASE, "Silicon, Elemental", None, None, "water", None, "Diss_SiO2", "x"),
    ],
)
CAST_NAMES = (_NAME_SCHEMA, _names(st.AGENCY_CASTS, {"click": "Temp", "view": "CPAR", "error": "remove"}))
WORKBOOK_NAMES = (
    _NAME_SCHEMA,
    _names(st.WORKBOOK, {"Secchi": "Secchi", "TP": "Tot_P", "SRP": "SRP", "SiO2": "Remove"})
    + _names(st.LAB_CASTS, {"click": "Temp", "view": "Remove"}),
)
COASTAL_NAMES = (
    _NAME_SCHEMA,
    _names(st.COASTAL_PROFILE_2010, {"Temperature": "Temp", "Corrected PAR": "CPAR", "Mean secchi": "Secchi", "Turbidity": "Remove"})
    + _names(st.COASTAL_CHEMISTRY_2015, {"Diss_NOx": "Diss_NOx", "CHLA": "Chla", "PTL": "Remove"}),
)

_KEYS_SQL = f"SELECT CodeName, lower(replace(Units, '/', '')) AS TargetUnits, LongName, Category, Explicit_Units FROM ({lookup_sql(KEY)})"
_CONV_SQL = (
    "SELECT DISTINCT ReportedUnits, TargetUnits, CAST(ConversionFactor AS DOUBLE) AS ConversionFactor "
    f"FROM ({lookup_sql(CONVERSIONS)})"
)


def _lookups(spark: SparkSession, **families: tuple) -> st.Lookups:
    names = {family: lookup(spark, spec) for family, spec in families.items()}
    return st.Lookups.of(
        lookup(spark, KEY), lookup(spark, CONVERSIONS), names, lookup(spark, _LIMIT_NAMES)
    )


def _duck(text: str) -> str:
    return text.replace(*_VARCHAR)


def _joined(source: str, left: str, units: str) -> str:
    """Key and conversion joins of a named table with ReportedUnits text `units`."""
    return f"""SELECT n.* EXCLUDE (ru), n.ru AS ReportedUnits, k.* EXCLUDE (CodeName), c.ConversionFactor
FROM (SELECT *, {units} AS ru FROM {source}) n LEFT JOIN ({_KEYS_SQL}) k ON n.CodeName IS NOT DISTINCT FROM k.CodeName
LEFT JOIN ({_CONV_SQL}) c ON n.ru IS NOT DISTINCT FROM c.ReportedUnits AND k.TargetUnits IS NOT DISTINCT FROM c.TargetUnits {left}"""


# --- lab database -------------------------------------------------------------------

_LAB_FIXED = (
    "SAMPLE_ID, YEAR, SEASON, STATION_ID, STN_DEPTH_M, LATITUDE, LONGITUDE, SAMPLING_DATE, TIME_ZONE, "
    "SAMPLE_DEPTH_M, DEPTH_CODE, MEDIUM, SAMPLE_TYPE, QC_TYPE"
)
_LAB_WIDE = """SELECT CAST(event_id AS STRING) AS SAMPLE_ID, CAST(1998 + event_id % 3 AS STRING) AS YEAR,
  CASE event_id % 4 WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' WHEN 3 THEN 'Summer' END AS SEASON,
  'MI' || (user_id % 12) AS STATION_ID, CASE WHEN event_id % 3 > 0 THEN CAST(50 + user_id % 12 AS STRING) END AS STN_DEPTH_M,
  CASE WHEN event_id % 5 > 0 AND user_id % 12 <> 7 THEN CAST(42 + user_id % 24 AS STRING) END AS LATITUDE,
  CASE WHEN event_id % 5 > 1 AND user_id % 12 <> 7 THEN CAST(0 - 87 - user_id % 24 AS STRING) END AS LONGITUDE,
  replace(substr(CAST(ts AS STRING), 1, 16), '-', '/') AS SAMPLING_DATE,
  CASE event_id % 6 WHEN 0 THEN 'EST' WHEN 1 THEN 'EDT' WHEN 2 THEN 'CDT' WHEN 3 THEN 'XXX' ELSE 'GMT' END AS TIME_ZONE,
  CAST(event_id % 61 AS STRING) AS SAMPLE_DEPTH_M,
  CASE event_id % 9 WHEN 0 THEN 'Integrated top' WHEN 1 THEN NULL ELSE 'Surface' END AS DEPTH_CODE, 'water' AS MEDIUM,
  CASE event_id % 10 WHEN 0 THEN 'Composite' WHEN 1 THEN 'INSITU_MEAS' ELSE 'Individual' END AS SAMPLE_TYPE,
  CASE event_id % 14 WHEN 0 THEN 'duplicate' ELSE 'routine field sample' END AS QC_TYPE, '1' AS Row,
  event_type AS ANALYTE_1,
  CASE WHEN event_id % 16 = 0 THEN 'INV' WHEN event_id % 18 = 0 THEN 'T' WHEN event_id % 15 = 0 THEN '<' || (event_id % 7 + 1)
       WHEN event_id % 21 = 0 THEN '0' WHEN event_id % 22 = 0 THEN '-' || (event_id % 5 + 1) WHEN event_id % 23 = 0 THEN NULL
       WHEN event_id % 25 = 0 THEN 'lots' ELSE CAST(event_id % 500 AS STRING) END AS VALUE_1,
  CASE WHEN event_id % 8 = 0 THEN 'none' WHEN event_type = 'click' THEN 'mg/L' WHEN event_type = 'purchase' THEN '%' ELSE 'ug/L' END AS UNITS_1,
  CASE WHEN user_id % 2 = 0 THEN 'Total' END AS FRACTION_1, CASE WHEN user_id % 3 > 0 THEN 'M' || (user_id % 3) END AS METHOD_1,
  CASE WHEN event_id % 15 = 0 THEN 'Less than Reporting Limit' WHEN event_id % 13 = 0 THEN 'odd' END AS RESULT_REMARK_1,
  CASE WHEN event_id % 3 = 0 THEN 'pH' END AS ANALYTE_2, '8' AS VALUE_2, 'none' AS UNITS_2,
  CASE WHEN event_id % 7 = 0 THEN 'Silicon, Elemental' END AS ANALYTE_3, '2' AS VALUE_3, 'mg/L' AS UNITS_3
FROM {events}"""
_LAB_SITES = ("Station VARCHAR, Latitude VARCHAR, Longitude VARCHAR", [("MI7", "44", "-86"), ("MI70", "1", "1")])
_LAB_OUT = (
    "UID, SITE_ID, Latitude, Longitude, stationDepth, sampleDepth, sampleDate, sampleDateTime, DEPTH_CODE, CodeName, ANALYTE, "
    "LongName, RESULT, MDL, RL, TargetUnits, ReportedUnits, ConversionFactor, METHOD, QAcomment, YEAR"
)


def _lab_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT {_LAB_FIXED}, ANALYTE_{k} AS ANALYTE, VALUE_{k} AS VALUE, UNITS_{k} AS UNITS, {f} AS FRACTION, {m} AS METHOD, {r} AS RESULT_REMARK FROM wide WHERE ANALYTE_{k} IS NOT NULL"
        for k, f, m, r in ((1, "FRACTION_1", "METHOD_1", "RESULT_REMARK_1"), (2, "NULL", "NULL", "NULL"), (3, "NULL", "NULL", "NULL"))
    )
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM b.{c}" for c in ("ANALYTE", "FRACTION", "METHOD", "YEAR"))
    name_join = " AND ".join(
        f"o.{a} IS NOT DISTINCT FROM m.{b}" for a, b in (("MEDIUM", "MEDIUM"), ("ANALYTE", "ANALYTE"), ("FRACTION", "FRACTION"), ("METHOD", "Methods"))
    )
    names = f"(SELECT * EXCLUDE (Units) FROM ({lookup_sql(LAB_NAMES)}))"
    sheet = _duck(_SEASON_SHEET.format(orders="orders"))
    conv = f"({_CONV_SQL})"
    return f"""WITH wide AS ({_duck(_LAB_WIDE.format(events='events'))}), long AS ({parts}),
kept AS (SELECT * FROM long WHERE SAMPLE_TYPE IN ('Individual', 'INSITU_MEAS') AND QC_TYPE = 'routine field sample'
  AND (VALUE IS NOT NULL OR RESULT_REMARK IS NOT NULL) AND NOT coalesce(regexp_matches(VALUE, '(?i)inv|no result|nrr|lac'), FALSE)
  AND VALUE NOT IN ('T', 'W') AND NOT coalesce(regexp_matches(DEPTH_CODE, '(?i)^integrated'), FALSE)),
counted AS (SELECT ANALYTE, FRACTION, METHOD, YEAR, UNITS, count(*) AS n FROM kept GROUP BY ALL),
best AS (SELECT ANALYTE, FRACTION, METHOD, YEAR, UNITS AS u FROM counted
  QUALIFY row_number() OVER (PARTITION BY ANALYTE, FRACTION, METHOD, YEAR ORDER BY n DESC, UNITS) = 1),
timed AS (SELECT o.* EXCLUDE (UNITS), CASE WHEN o.UNITS = 'none' THEN b.u ELSE o.UNITS END AS UNITS,
  CAST(replace(o.SAMPLING_DATE, '/', '-') || ':00' AS TIMESTAMP) + CASE o.TIME_ZONE WHEN 'EST' THEN INTERVAL 5 HOUR
    WHEN 'CDT' THEN INTERVAL 5 HOUR WHEN 'EDT' THEN INTERVAL 4 HOUR WHEN 'GMT' THEN INTERVAL 0 HOUR END AS t
  FROM kept o LEFT JOIN best b ON {same}),
rl0 AS (SELECT DISTINCT CAST(o.YEAR AS DOUBLE) AS YEAR, o.SEASON, m.CodeName, k.TargetUnits, lower(replace(o.UNITS, '/', '')) AS ru,
  CAST(replace(o.VALUE, '<', '') AS DOUBLE) AS v FROM timed o LEFT JOIN {names} m ON {name_join}
  LEFT JOIN ({_KEYS_SQL}) k ON m.CodeName IS NOT DISTINCT FROM k.CodeName WHERE starts_with(o.VALUE, '<')),
rl AS (SELECT DISTINCT r.YEAR, r.SEASON, r.CodeName, coalesce(r.v * c.ConversionFactor, r.v) AS rl FROM rl0 r
  LEFT JOIN {conv} c ON r.ru IS NOT DISTINCT FROM c.ReportedUnits AND r.TargetUnits IS NOT DISTINCT FROM c.TargetUnits),
sheet AS ({sheet}),
sheet_rows AS (SELECT split_part("Survey (Units)", ' ', 1) AS SEASON, CAST(split_part("Survey (Units)", ' ', 2) AS DOUBLE) AS YEAR, * FROM sheet),
mdl AS (SELECT YEAR, SEASON, 'Tot_P' AS CodeName, nullif(CAST("Total Phosphorus (ug/l)" AS DOUBLE), 0) AS mdl FROM sheet_rows
  UNION ALL SELECT YEAR, SEASON, 'Diss_SiO2', nullif(CAST("Dissolved Silica (as Si) (mg/l)" AS DOUBLE), 0) * 1e-3 * CAST('2.13918214' AS DOUBLE) FROM sheet_rows
  UNION ALL SELECT YEAR, SEASON, 'Chla', nullif(CAST("Chlorophyll (ug/l)" AS DOUBLE), 0) FROM sheet_rows),
grid AS (SELECT s.SEASON, CAST(y.YEAR AS DOUBLE) AS YEAR FROM (VALUES ('Spring'), ('Summer')) AS s(SEASON), generate_series(1983, 2012) AS y(YEAR)),
empty AS (SELECT g.YEAR, g.SEASON, c.CodeName, NULL AS mdl FROM grid g CROSS JOIN (VALUES ('Tot_P'), ('Diss_SiO2'), ('Chla')) AS c(CodeName)
  WHERE NOT EXISTS (SELECT 1 FROM sheet_rows r WHERE r.YEAR = g.YEAR AND r.SEASON = g.SEASON)),
limits AS (SELECT YEAR, SEASON, CodeName, mdl, NULL AS rl FROM mdl UNION ALL SELECT YEAR, SEASON, CodeName, mdl, NULL FROM empty
  UNION ALL SELECT YEAR, SEASON, CodeName, NULL, rl FROM rl),
nums AS (SELECT * EXCLUDE (LATITUDE, LONGITUDE, STN_DEPTH_M, SEASON), CAST(LATITUDE AS DOUBLE) AS la, CAST(LONGITUDE AS DOUBLE) AS lo,
  CAST(STN_DEPTH_M AS DOUBLE) AS sd, coalesce(SEASON, CAST(month(t) AS VARCHAR)) AS SEASON FROM timed),
means AS (SELECT STATION_ID, avg(la) AS mla, avg(lo) AS mlo, avg(sd) AS msd FROM nums GROUP BY ALL),
placed AS (SELECT n.*, coalesce(n.la, m.mla, CAST(s.Latitude AS DOUBLE)) AS Latitude, coalesce(n.lo, m.mlo, CAST(s.Longitude AS DOUBLE)) AS Longitude,
  coalesce(n.sd, m.msd) AS stationDepth, TRY_CAST(n.VALUE AS DOUBLE) AS v FROM nums n JOIN means m ON n.STATION_ID = m.STATION_ID
  LEFT JOIN ({lookup_sql(_LAB_SITES)}) s ON n.STATION_ID = s.Station),
named AS (SELECT o.*, m.CodeName FROM placed o LEFT JOIN {names} m ON {name_join}
  WHERE m.CodeName IS NULL OR NOT regexp_matches(m.CodeName, '(?i)remove')),
unit AS ({_joined('named', '', "CASE WHEN ANALYTE = 'pH' THEN 'unitless' WHEN UNITS = '%' THEN 'percent' ELSE lower(replace(UNITS, '/', '')) END")}),
res AS (SELECT * EXCLUDE (YEAR), CAST(YEAR AS DOUBLE) AS YEAR, coalesce(v * ConversionFactor, v) * CASE WHEN ANALYTE = 'Silicon, Elemental' THEN CAST('2.13918214' AS DOUBLE) ELSE 1e0 END AS r,
  CASE WHEN v IS NULL THEN coalesce(RESULT_REMARK, 'NA') || '; ' || coalesce(VALUE, 'NA') ELSE RESULT_REMARK END AS q FROM unit),
lim AS (SELECT r.*, l.mdl AS MDL, l.rl AS RL FROM res r LEFT JOIN limits l ON r.CodeName IS NOT DISTINCT FROM l.CodeName
  AND r.YEAR IS NOT DISTINCT FROM l.YEAR AND r.SEASON IS NOT DISTINCT FROM l.SEASON)
SELECT SAMPLE_ID AS UID, STATION_ID AS SITE_ID, {steady_sql('Latitude')} AS Latitude, {steady_sql('Longitude')} AS Longitude, {steady_sql('stationDepth')} AS stationDepth,
  CAST(SAMPLE_DEPTH_M AS DOUBLE) AS sampleDepth, CAST(t AS DATE) AS sampleDate, t AS sampleDateTime, DEPTH_CODE, CodeName, ANALYTE, LongName,
  CASE WHEN CodeName = 'Turb_NTU' AND r < 0 THEN 0e0 ELSE r END AS RESULT, {steady_sql('MDL')} AS MDL, {steady_sql('RL')} AS RL, TargetUnits, ReportedUnits, ConversionFactor, METHOD,
  CASE WHEN q IS NULL AND ((r = 0 AND CodeName IN ('SRP','Diss_P','Chla','Diss_NHx')) OR (r < 0 AND CodeName IN ('Tot_P','SRP','Diss_NHx','Diss_P','Chla')))
       THEN 'Method Detection Limit, less than' ELSE q END AS QAcomment, YEAR FROM lim"""


@query(_lab_sql())
def source_lab_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = spark.sql(_LAB_WIDE, events=table(spark, sf_dir, "events"))
    sheet = spark.sql(_SEASON_SHEET.replace('"', "`"), orders=table(spark, sf_dir, "orders"))
    clean = lab_database.clean(
        lab_database.read(wide), _lookups(spark, lab=LAB_NAMES), lookup(spark, _LAB_SITES), sheet
    )
    rounded = ["Latitude", "Longitude", "stationDepth", "MDL", "RL"]
    return clean.withColumns({c: steady(c) for c in rounded}).select(*_LAB_OUT.split(", "))


# --- casts ---------------------------------------------------------------------------

_AGENCY = """SELECT 'raw/' || event_id || '_' || CASE user_id % 9 WHEN 0 THEN 'MI18MA' WHEN 1 THEN 'MI18MB' WHEN 2 THEN 'MI41M-A'
   WHEN 3 THEN 'MIcast2' WHEN 4 THEN 'MI,1' WHEN 5 THEN 'MIderived' ELSE 'MI' || (user_id % 30) END || ' x.cnv' AS STATION_ID,
  ts AS sampleDateTime, CAST(event_id % 80 AS DOUBLE) AS sampleDepth, CAST(NULL AS DOUBLE) AS stationDepth, 42e0 AS Latitude, -87e0 AS Longitude,
  CASE event_type WHEN 'view' THEN 'cpar' WHEN 'signup' THEN 'pH' ELSE event_type END AS ANALYTE,
  CASE WHEN event_id % 7 > 0 THEN value END AS RESULT, CASE WHEN event_type = 'click' THEN 'C' END AS UNITS FROM {events}"""
_AGENCY_NAMES = (_NAME_SCHEMA, _names(st.AGENCY_CASTS, {"click": "Temp", "cpar": "CPAR", "pH": "pH", "error": "remove"}))


@query(
    f"""WITH raw AS ({_duck(_AGENCY.format(events='events'))}),
site AS (SELECT *, split_part(split_part(replace(split_part(STATION_ID, '/', 2), '.cnv', ''), '_', 2), ' ', 1) AS s FROM raw),
good AS (SELECT *, CASE s WHEN 'MI18MA' THEN 'MI18M' WHEN 'MI41M-A' THEN 'MI41M' ELSE s END AS SITE_ID FROM site
  WHERE NOT regexp_matches(s, '(?i)cast|derive|,') AND s NOT IN ('MI18MB', 'MI27M-B', 'MI27MB', 'MI41M-B', 'MI41MB') AND RESULT IS NOT NULL),
named AS (SELECT g.*, m.CodeName FROM good g LEFT JOIN ({lookup_sql(_AGENCY_NAMES)}) m ON g.ANALYTE = m.ANALYTE
  WHERE m.CodeName IS NULL OR NOT regexp_matches(m.CodeName, '(?i)remove')),
unit AS ({_joined('named', '', "CASE ANALYTE WHEN 'cpar' THEN 'percent' WHEN 'pH' THEN 'unitless' ELSE lower(UNITS) END")}),
deep AS (SELECT SITE_ID, max(sampleDepth) AS d FROM unit GROUP BY ALL)
SELECT 'SeaBird_' || u.s || '_' || CAST(CAST(u.sampleDateTime AS DATE) AS VARCHAR) || '_' || CAST(CAST(u.sampleDepth AS BIGINT) AS VARCHAR) AS UID,
  u.SITE_ID, u.sampleDepth, CAST(u.sampleDateTime AS DATE) AS sampleDate, u.CodeName, u.ANALYTE, u.ReportedUnits, u.TargetUnits,
  coalesce(u.RESULT * u.ConversionFactor, u.RESULT) * CASE WHEN u.CodeName = 'CPAR' THEN 100 ELSE 1 END AS RESULT,
  CAST(year(u.sampleDateTime) AS DOUBLE) AS YEAR, deep.d AS maxCTDdepth FROM unit u JOIN deep ON u.SITE_ID = deep.SITE_ID"""
)
def source_agency_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_AGENCY, events=table(spark, sf_dir, "events"))
    out = casts.agency_casts(raw, _lookups(spark, casts=_AGENCY_NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDepth", "sampleDate", "CodeName", "ANALYTE", "ReportedUnits", "TargetUnits",
        "RESULT", "YEAR", "maxCTDdepth",
    )


_LAB_CTD = """SELECT CASE user_id % 6 WHEN 0 THEN 'x/M45.cnv' WHEN 1 THEN 'x/M110.cnv' WHEN 2 THEN 'y/M15d1730.cnv'
   WHEN 3 THEN 'z/302_102913_0758_M45_day.cnv' ELSE 'w/a.cnv' END AS ctdFiles,
  CASE user_id % 6 WHEN 0 THEN 'beta' WHEN 1 THEN 'omega' ELSE 'gamma' END AS SITE_ID, ts AS sampleDateTime,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP_NTZ '2019-12-16 05:00:00' WHEN event_id % 7 = 0 THEN TIMESTAMP_NTZ '1909-07-20 04:00:00' END AS sampleDateTime_ctd,
  43e0 AS Latitude, CASE WHEN event_id % 2 = 0 THEN 43.5e0 END AS Latitude_ctd, -86e0 AS Longitude, CAST(NULL AS DOUBLE) AS Longitude_ctd,
  20e0 AS stationDepth, CAST(NULL AS DOUBLE) AS stationDepth_ctd, CAST(event_id % 40 AS DOUBLE) / 2 AS sampleDepth, event_type AS ANALYTE,
  CASE WHEN event_id % 11 > 0 THEN value END AS RESULT, 'C' AS UNITS FROM {events}"""


@query(
    f"""WITH raw AS ({_LAB_CTD.format(events='events').replace('TIMESTAMP_NTZ', 'TIMESTAMP')}),
own AS (SELECT ctdFiles, SITE_ID AS s0, ANALYTE, RESULT, UNITS, sampleDepth, coalesce(Latitude_ctd, Latitude) AS la,
  CASE WHEN year(coalesce(sampleDateTime_ctd, sampleDateTime)) = 1909 THEN coalesce(sampleDateTime_ctd, sampleDateTime) + INTERVAL 100 YEAR
       ELSE coalesce(sampleDateTime_ctd, sampleDateTime) END AS t FROM raw WHERE RESULT IS NOT NULL),
named AS (SELECT o.*, m.CodeName FROM own o LEFT JOIN ({lookup_sql(WORKBOOK_NAMES)}) m ON m.Study = 'NOAActd' AND o.ANALYTE = m.ANALYTE
  WHERE m.CodeName IS NULL OR NOT regexp_matches(m.CodeName, '(?i)remove')),
swap AS (SELECT *, CASE WHEN CAST(t AS DATE) = DATE '2019-12-16' AND contains(ctdFiles, 'M45') AND s0 = 'beta' THEN 'omega'
   WHEN CAST(t AS DATE) = DATE '2019-12-16' AND contains(ctdFiles, 'M110') AND s0 = 'omega' THEN 'beta'
   WHEN contains(ctdFiles, 'M15d1730.cnv') THEN 'alpha' ELSE s0 END AS SITE_ID FROM named WHERE NOT contains(ctdFiles, '302_102913_0758_M45_day')),
spot AS (SELECT *, CASE WHEN SITE_ID = 'alpha' THEN 'alpha' WHEN SITE_ID <> s0 THEN SITE_ID END AS p FROM swap)
SELECT 'NOAActd_' || SITE_ID || '_' || CAST(CAST(t AS DATE) AS VARCHAR) || '_' ||
   CASE WHEN sampleDepth = floor(sampleDepth) THEN CAST(CAST(sampleDepth AS BIGINT) AS VARCHAR) ELSE CAST(sampleDepth AS VARCHAR) END AS UID,
  SITE_ID, t AS sampleDateTime, CodeName, ANALYTE, RESULT, 'c' AS ReportedUnits,
  CASE p WHEN 'alpha' THEN 43.18816667e0 WHEN 'beta' THEN 43.20616667e0 WHEN 'omega' THEN 43.19983333e0 ELSE la END AS Latitude,
  CASE p WHEN 'alpha' THEN 18e0 WHEN 'beta' THEN 45e0 WHEN 'omega' THEN 110e0 ELSE 20e0 END AS stationDepth FROM spot"""
)
def source_lab_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_LAB_CTD, events=table(spark, sf_dir, "events"))
    out = casts.lab_casts(raw, _lookups(spark, workbook=WORKBOOK_NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDateTime", "CodeName", "ANALYTE", "RESULT", "ReportedUnits", "Latitude", "stationDepth"
    )


# --- workbook --------------------------------------------------------------------------

_SHEET = """SELECT year(o_orderdate) AS Year, month(o_orderdate) AS Month, day(o_orderdate) AS Day,
  CASE o_custkey % 5 WHEN 0 THEN 'Leg s' || (o_custkey % 18) WHEN 1 THEN 'S ' || (o_custkey % 18) ELSE 's#' || (o_custkey % 18) END AS Station,
  CAST(o_custkey % 4 AS DOUBLE) * 5 AS `Depth.m`,
  CASE o_orderkey % 6 WHEN 0 THEN 'on bottom' WHEN 1 THEN '7..5' WHEN 2 THEN NULL ELSE CAST(o_custkey % 20 AS STRING) END AS `Secchi.m`,
  CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey % 30 AS STRING) END AS `TP.ugl`, CASE WHEN o_orderkey % 9 > 0 THEN '?' ELSE '3' END AS `PP.ugl`
FROM {orders}"""
_SUPPLEMENT = """SELECT 2011 AS Year, 1 + CAST(c_custkey % 12 AS INT) AS Month, 1 + CAST(c_custkey % 28 AS INT) AS Day, 'S' || (c_custkey % 18) AS Station,
  CAST(c_nationkey AS DOUBLE) AS Depth, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS `SRP.ugl`, 1e0 AS `SiO2.mgl` FROM {customer}"""
_ALIASES = (
    "alias VARCHAR, SITE_ID VARCHAR, Keep VARCHAR, Justification VARCHAR",
    [(f"s{i}", f"site-{i % 7}", "T" if i % 5 else "F", None) for i in range(18)],
)


def _site_name(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower({c}), '[ \\t]', '', 'g'), 'leg', ''), '#', '')"


@query(
    f"""WITH a AS (SELECT alias, SITE_ID FROM ({lookup_sql(_ALIASES)}) WHERE Keep = 'T'),
m0 AS ({_duck(_SHEET.format(orders='orders')).replace('`', '"')}), x0 AS ({_duck(_SUPPLEMENT.format(customer='customer')).replace('`', '"')}),
m AS (SELECT a.SITE_ID, m0.* EXCLUDE (Station) FROM m0 JOIN a ON {_site_name('Station')} = a.alias),
long AS (SELECT DISTINCT Year, Month, Day, SITE_ID, NULL::DOUBLE AS sampleDepth, 'Secchi' AS ANALYTE, 'm' AS ReportedUnits,
    TRY_CAST(CASE WHEN "Secchi.m" = '7..5' THEN '7.5' ELSE "Secchi.m" END AS DOUBLE) AS RESULT, CASE WHEN contains("Secchi.m", 'bottom') THEN 'CTB' END AS QAcode FROM m
  UNION ALL SELECT DISTINCT Year, Month, Day, SITE_ID, "Depth.m", 'TP', 'ugl', TRY_CAST("TP.ugl" AS DOUBLE), NULL FROM m
  UNION ALL SELECT DISTINCT Year, Month, Day, SITE_ID, "Depth.m", 'PP', 'ugl', TRY_CAST("PP.ugl" AS DOUBLE), NULL FROM m
  UNION ALL SELECT Year, Month, Day, a.SITE_ID, Depth, 'SRP', 'ugl', "SRP.ugl", NULL FROM x0 JOIN a ON {_site_name('Station')} = a.alias WHERE "SRP.ugl" IS NOT NULL)
SELECT 'NOAA_WQ-' || SITE_ID || '-' || Year || '-' || Month || '-' || Day || '-' || coalesce(CAST(CAST(sampleDepth AS BIGINT) AS VARCHAR), 'NA') AS UID,
  SITE_ID, sampleDepth, make_date(Year, Month, Day) AS sampleDate, CASE ANALYTE WHEN 'Secchi' THEN 'Secchi' WHEN 'TP' THEN 'Tot_P' WHEN 'SRP' THEN 'SRP' END AS CodeName,
  ANALYTE, ReportedUnits, RESULT, CASE WHEN ANALYTE = 'TP' THEN 2e-1 END AS MDL, QAcode, CASE WHEN QAcode IS NOT NULL THEN 'Secchi clear to bottom' END AS QAcomment
FROM long WHERE (RESULT IS NOT NULL OR QAcode IS NOT NULL) AND (RESULT <> 0 OR QAcode IS NOT NULL)"""
)
def source_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = spark.sql(_SHEET, orders=table(spark, sf_dir, "orders"))
    extra = spark.sql(_SUPPLEMENT, customer=table(spark, sf_dir, "customer"))
    aliases = lookup(spark, _ALIASES).withColumnRenamed("alias", "Other.names")
    out = workbook.load(
        main, extra, aliases, _lookups(spark, workbook=WORKBOOK_NAMES), ["Secchi.m", "TP.ugl", "PP.ugl"]
    )
    return out.select(
        "UID", "SITE_ID", "sampleDepth", "sampleDate", "CodeName", "ANALYTE", "ReportedUnits", "RESULT", "MDL", "QAcode", "QAcomment"
    )


# --- coastal chemistry ------------------------------------------------------------------

_CHEMISTRY = """SELECT CAST(l_orderkey AS DOUBLE) AS UID, 'S' || (l_orderkey % 40) AS SITE_ID, 'L' || (l_orderkey % 3) AS LAB,
  CASE l_linenumber WHEN 1 THEN 'NITRITE_N' WHEN 2 THEN 'NITRATE_N' WHEN 3 THEN 'CHLA' WHEN 4 THEN 'PTL' ELSE 'COND' END AS ANALYTE,
  CAST(day(l_shipdate) AS STRING) || '-' || substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', month(l_shipdate) * 3 - 2, 3) || '-' || year(l_shipdate) AS DATE_COL,
  CASE WHEN l_suppkey % 2 = 0 THEN l_tax END AS LRL, l_discount AS MDL, CAST(NULL AS STRING) AS METHOD,
  CASE WHEN l_partkey % 6 > 0 THEN l_quantity END AS RESULT, 'x' AS RESULT_UNITS, CAST(l_orderkey AS STRING) AS SAMPLE_ID,
  CASE WHEN l_linenumber = 3 THEN l_returnflag || ',' || l_linestatus END AS NARS_FLAG, CASE WHEN l_linenumber = 3 THEN l_linestatus || ';' END AS NARS_COMMENT
FROM {lineitem}"""
_COAST_SITES = """SELECT DISTINCT CAST(o_orderkey AS DOUBLE) AS UID, 'S' || (o_orderkey % 40) AS SITE_ID, 42e0 + o_orderkey % 3 AS LAT_DD83,
  -87e0 AS LON_DD83, CASE WHEN o_orderkey % 4 > 0 THEN 10e0 + o_orderkey % 9 END AS STATION_DEPTH, 'Lake Michigan' AS GREAT_LAKE FROM {orders}"""


@query(
    f"""WITH raw AS (SELECT *, CAST(strptime(DATE_COL, '%d-%b-%Y') AS DATE) AS d FROM ({_duck(_CHEMISTRY.format(lineitem='lineitem'))})),
sites AS (SELECT * FROM ({_COAST_SITES.format(orders='orders')}) WHERE STATION_DEPTH IS NOT NULL),
nox AS (SELECT UID, SITE_ID, LAB, d, avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN RESULT END) AS a, avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN RESULT END) AS b,
  avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN MDL END) + avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN MDL END) AS MDL,
  avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN LRL END) + avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN LRL END) AS LRL
  FROM raw WHERE ANALYTE IN ('NITRITE_N', 'NITRATE_N') GROUP BY ALL),
paired AS (SELECT UID, SITE_ID, d, 'Diss_NOx' AS CodeName, (a + b) * 1000 AS RESULT, MDL * 1000 AS MDL, LRL * 1000 AS RL, NULL AS QAcode, 'NA' AS QAcomment FROM nox WHERE (a IS NULL) = (b IS NULL)
  UNION ALL SELECT UID, SITE_ID, d, 'Chla', RESULT, MDL, LRL, replace(NARS_FLAG, ';', ','), replace(NARS_COMMENT, ';', '') FROM raw WHERE ANALYTE = 'CHLA')
SELECT b.UID, b.SITE_ID, b.d AS sampleDate, b.CodeName, {steady_sql('b.RESULT')} AS RESULT, {steady_sql('b.MDL')} AS MDL, {steady_sql('b.RL')} AS LRL, b.QAcode, b.QAcomment, s.STATION_DEPTH AS stationDepth, s.LAT_DD83 AS Latitude
FROM paired b LEFT JOIN sites s ON b.UID = s.UID AND b.SITE_ID = s.SITE_ID"""
)
def source_coastal_chemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_CHEMISTRY, lineitem=table(spark, sf_dir, "lineitem"))
    sites = coastal.sites_2015(spark.sql(_COAST_SITES, orders=table(spark, sf_dir, "orders")))
    out = coastal.chemistry_2015(raw, sites, _lookups(spark, coastal=COASTAL_NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDate", "CodeName", steady("RESULT").alias("RESULT"), steady("MDL").alias("MDL"),
        steady("LRL").alias("LRL"), "QAcode", "QAcomment", "stationDepth", "Latitude",
    )


# --- coastal profiles ---------------------------------------------------------------------

_PROFILE = """SELECT CAST(user_id AS DOUBLE) AS UID, CASE WHEN user_id % 6 = 0 THEN 'X' WHEN user_id % 6 = 1 THEN 'NCCAGL10-1095' ELSE 'GL' || (user_id % 6) END AS SITE_ID,
  month(ts) || '/' || day(ts) || '/' || year(ts) AS DATE_COL, CASE event_id % 5 WHEN 0 THEN 'UPCAST' WHEN 1 THEN 'IM_CALC' ELSE 'DOWNCAST' END AS CAST,
  CASE WHEN event_id % 13 = 0 THEN -9e0 ELSE CAST(event_id % 3 AS DOUBLE) END AS SDEPTH, 20e0 + user_id % 3 AS `STATION_DEPTH(m)`, 'p' AS PARAMETER,
  CASE event_type WHEN 'click' THEN 'Ambient PAR' WHEN 'view' THEN 'Underwater PAR' WHEN 'error' THEN 'Temperature' WHEN 'signup' THEN 'Mean secchi' ELSE 'Turbidity' END AS PARAMETER_NAME,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_type = 'signup' AND event_id % 19 = 0 THEN -9e0 ELSE value END AS RESULT, 'C' AS UNITS,
  CASE WHEN event_id % 4 = 0 THEN 'Q' END AS QA_CODE, CAST(NULL AS STRING) AS QA_COMMENT FROM {events}"""
_PROFILE_SITES = (
    "SITE_ID VARCHAR, ALAT_DD DOUBLE, ALON_DD DOUBLE, STATION_DEPTH DOUBLE, WTBDY_NM VARCHAR, NCCR_REG VARCHAR",
    [("NCCAGL10-1095", 43.0, -87.0, 9.0, "Lake Michigan", "Great Lakes")]
    + [(f"GL{i}", 42.0 + i, -86.0, 30.0, "Lake Huron", "Great Lakes") for i in range(2, 5)]
    + [("GL5", 1.0, 2.0, 3.0, "Sea", "Gulf")],
)


@query(
    f"""WITH raw AS (SELECT UID, SITE_ID, DATE_COL, "CAST" AS k, nullif(SDEPTH, -9) AS sampleDepth, sd, PARAMETER_NAME AS ANALYTE, RESULT, QA_CODE, event_id
  FROM ({_duck(_PROFILE.format(events='events')).replace('`STATION_DEPTH(m)`', 'sd').replace('END AS CAST,', 'END AS "CAST",').replace(" FROM events", ", event_id FROM events")})
  WHERE contains(SITE_ID, 'GL') AND "CAST" IN ('DOWNCAST', 'IM_CALC')),
grp AS (SELECT UID, SITE_ID, DATE_COL, k, sampleDepth, sd, ANALYTE, avg(RESULT) AS RESULT, count(DISTINCT coalesce(QA_CODE, 'NA')) AS n,
  CASE WHEN count(DISTINCT coalesce(QA_CODE, 'NA')) = 1 THEN min(coalesce(QA_CODE, 'NA')) WHEN arg_min(coalesce(QA_CODE, 'NA'), event_id) = 'NA' THEN 'NA, Q' ELSE 'Q, NA' END AS q, min(event_id) AS ord FROM raw GROUP BY ALL),
deep AS (SELECT SITE_ID, DATE_COL, UID, max(sd) AS deepest FROM grp GROUP BY ALL),
g AS (SELECT grp.* EXCLUDE (sd), deep.deepest AS sd FROM grp JOIN deep USING (SITE_ID, DATE_COL, UID)),
own AS (SELECT * FROM g WHERE ANALYTE IN ('Ambient PAR', 'Underwater PAR')),
par AS (SELECT UID, SITE_ID, DATE_COL, k, sampleDepth, sd, 100 * (avg(CASE WHEN ANALYTE = 'Underwater PAR' THEN RESULT END) / nullif(avg(CASE WHEN ANALYTE = 'Ambient PAR' THEN RESULT END), 0)) AS RESULT,
  string_agg(q, ', ' ORDER BY ord) AS qs, count(DISTINCT q) AS nq, min(q) AS q1 FROM own GROUP BY ALL),
every AS (SELECT UID, SITE_ID, DATE_COL, k, sampleDepth, sd, 'Corrected PAR' AS ANALYTE, RESULT, CASE WHEN nq = 1 THEN q1 ELSE qs END AS q FROM par WHERE RESULT IS NOT NULL
  UNION ALL SELECT UID, SITE_ID, DATE_COL, k, sampleDepth, sd, ANALYTE, CASE WHEN ANALYTE = 'Mean secchi' AND RESULT = -9 THEN NULL ELSE RESULT END, q FROM g
  WHERE ANALYTE IN ('Temperature', 'Mean secchi'))
SELECT UID, SITE_ID, k AS cast_kind, sampleDepth, CASE WHEN SITE_ID = 'NCCAGL10-1095' THEN 9e0 ELSE sd END AS stationDepth,
  CAST(strptime(DATE_COL, '%m/%d/%Y') AS DATE) AS sampleDate, ANALYTE, {steady_sql('RESULT', 4)} AS RESULT, q AS QAcode,
  CASE ANALYTE WHEN 'Corrected PAR' THEN 'percent' WHEN 'Mean secchi' THEN 'm' ELSE 'c' END AS ReportedUnits,
  CASE WHEN SITE_ID = 'GL5' THEN NULL WHEN SITE_ID = 'NCCAGL10-1095' THEN 'Lake Michigan' ELSE 'Lake Huron' END AS WTBDY_NM FROM every"""
)
def source_coastal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_PROFILE, events=table(spark, sf_dir, "events"))
    sites = coastal.sites_2010(lookup(spark, _PROFILE_SITES))
    out = coastal.profile_2010(raw, sites, _lookups(spark, coastal=COASTAL_NAMES))
    return out.select(
        "UID", "SITE_ID", F.col("CAST").alias("cast_kind"), "sampleDepth", "stationDepth", "sampleDate", "ANALYTE",
        steady("RESULT", 4).alias("RESULT"), "QAcode", "ReportedUnits", "WTBDY_NM",
    )


# --- instrument text ----------------------------------------------------------------------

_SCAN_LINES = """SELECT 'casts/' || user_id || '.cnv' AS path, 100 + event_id AS line_no, '  ' || (CAST((event_id * 7) % 41 AS DOUBLE) / 2) || ' ' || value || ' '
  || CASE WHEN event_id % 5 = 0 THEN '0.0' ELSE '100.0' END || '  50.0' AS line FROM {events}"""
_HEADER = [
    (1, "* NMEA Latitude = 43 30.00 N"),
    (2, "# name 0 = depSM: Depth [salt water, m]"),
    (3, "# name 1 = t090C: Temperature"),
    (4, "# name 2 = spar: Surface light"),
    (5, "# name 3 = par: Light"),
    (6, "# start_time = Jul 19 2010 17:30:00"),
    (7, "*END*"),
]


@query(
    f"""WITH s AS (SELECT 'casts/' || user_id || '.cnv' AS path, event_id AS scan, CAST((event_id * 7) % 41 AS DOUBLE) / 2 AS depth, value AS t,
  CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE 100e0 END AS spar FROM events),
turn AS (SELECT path, arg_min(scan, -depth * 1e9 + scan) AS turn FROM s GROUP BY ALL),
down AS (SELECT s.* FROM s JOIN turn USING (path) WHERE scan <= turn),
ref AS (SELECT *, median(t) OVER near AS t_ref, median(spar) OVER near AS spar_ref FROM down
  WINDOW near AS (PARTITION BY path ORDER BY scan ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
sd AS (SELECT path, stddev_samp(t - t_ref) AS t_sd, stddev_samp(spar - spar_ref) AS spar_sd FROM ref GROUP BY path),
d AS (SELECT path, depth, CASE WHEN abs(t - t_ref) > 4e0 * t_sd THEN t_ref ELSE t END AS t,
  CASE WHEN abs(spar - spar_ref) > 4e0 * spar_sd THEN spar_ref ELSE spar END AS spar
  FROM ref JOIN sd USING (path) WHERE depth > 1e-1 AND depth >= 5e-1),
b AS (SELECT path, CAST(floor(depth - 5e-1) + 1 AS DOUBLE) AS sampleDepth, avg(t) AS temperature, avg(CASE WHEN spar > 0 THEN 50e0 / spar END) AS cpar FROM d GROUP BY ALL)
SELECT path AS STATION_ID, sampleDepth, 'temperature' AS ANALYTE, {steady_sql('temperature')} AS RESULT, 'C' AS UNITS, TIMESTAMP '2010-07-19 17:30:00' AS sampleDateTime, 43.5e0 AS Latitude FROM b
UNION ALL SELECT path, sampleDepth, 'cpar', {steady_sql('cpar')}, NULL, TIMESTAMP '2010-07-19 17:30:00', 43.5e0 FROM b WHERE cpar IS NOT NULL"""
)
def source_cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    scans = spark.sql(_SCAN_LINES, events=table(spark, sf_dir, "events"))
    head = [F.struct(F.lit(i).cast("bigint").alias("line_no"), F.lit(x).alias("line")) for i, x in _HEADER]
    lines = scans.select("path").distinct().select("path", F.inline(F.array(*head))).unionByName(scans)
    out = cast_files.cast_table(lines)
    return out.select(
        "STATION_ID", "sampleDepth", "ANALYTE", steady("RESULT").alias("RESULT"), "UNITS", "sampleDateTime", "Latitude"
    )
