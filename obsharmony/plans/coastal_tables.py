"""Queries: the coastal survey's 2015 profiles and Secchi readings, 2010 and 2020 chemistry, and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import coastal
from ..sources import standard as st
from .catalog import query, steady, steady_sql, table
from .source_tables import _COAST_SITES, _NAME_SCHEMA, _duck, _lookups, _names

NAMES = (
    _NAME_SCHEMA,
    _names(st.COASTAL_PROFILE_2015, {"TEMPERATURE": "Temp", "Corrected PAR": "CPAR", "PH": "pH", "TRANS": "Remove"})
    + _names(st.COASTAL_SECCHI_2015, {"Secchi": "Secchi"})
    + _names(st.COASTAL_CHEMISTRY_2020, {"Diss_NOx": "Diss_NOx", "CHLA": "Chla", "PTL": "Remove"})
    + [
        (st.COASTAL_CHEMISTRY_2010, "Chlorophyll A", "CHLA", None, None, None, "Chla", "x"),
        (st.COASTAL_CHEMISTRY_2010, "Phosphorus", "PTL", None, None, None, "Tot_P", "x"),
        (st.COASTAL_CHEMISTRY_2010, "Salinity", "Salinity", None, None, None, "Remove", "x"),
    ],
)

_SITES_SQL = f"sites AS (SELECT * FROM ({_COAST_SITES.format(orders='orders')}) WHERE STATION_DEPTH IS NOT NULL)"

_PROFILE = """SELECT CAST(user_id AS DOUBLE) AS UID, 'S' || (user_id % 40) AS SITE_ID, 42000e0 + event_id % 300 AS DATE_COL,
  CASE WHEN event_id % 3 = 0 THEN 'UPCAST' WHEN event_id % 31 > 0 THEN 'DOWNCAST' END AS CAST, CAST(event_id % 20 AS DOUBLE) AS DEPTH,
  CASE WHEN event_id % 7 = 0 THEN 'rough sea' END AS NARS_COMMENT, 77e0 AS STATION_DEPTH_FILE, value AS TRANS, value / 2 AS CONDUCTIVITY, value / 3 AS DO,
  CASE WHEN event_id % 11 > 0 THEN value / 10 END AS PH, value + 1 AS TEMPERATURE, value * (event_id % 3) AS LIGHT_UW, CAST(event_id % 5 AS DOUBLE) AS LIGHT_AMB
FROM {events}"""


@query(
    f"""WITH {_SITES_SQL},
raw AS (SELECT *, DATE '1899-12-30' + CAST(floor(DATE_COL) AS INTEGER) AS d FROM ({_duck(_PROFILE).replace(' AS CAST,', ' AS kind,').replace(' AS DO,', ' AS oxygen,').format(events='events')})),
long AS (
  SELECT UID, SITE_ID, d, DEPTH, NARS_COMMENT, x.a AS ANALYTE, x.v AS RESULT, x.c AS CodeName, x.u AS ReportedUnits FROM (
    SELECT *, unnest([
      {{'a': 'CONDUCTIVITY', 'v': CONDUCTIVITY, 'c': NULL, 'u': 'uscm'}}, {{'a': 'DO', 'v': oxygen, 'c': NULL, 'u': 'mgl'}},
      {{'a': 'PH', 'v': PH, 'c': 'pH', 'u': 'unitless'}}, {{'a': 'TEMPERATURE', 'v': TEMPERATURE, 'c': 'Temp', 'u': 'c'}},
      {{'a': 'Corrected PAR', 'v': 100 * (LIGHT_UW / nullif(LIGHT_AMB, 0)), 'c': 'CPAR', 'u': 'percent'}}]) AS x
    FROM raw WHERE kind = 'DOWNCAST') WHERE x.v IS NOT NULL)
SELECT l.UID, l.SITE_ID, d AS sampleDate, DEPTH AS sampleDepth, ANALYTE, CodeName, ReportedUnits, {steady_sql('RESULT')} AS RESULT, NARS_COMMENT AS QAcomment,
  s.STATION_DEPTH AS stationDepth, s.LAT_DD83 AS Latitude
FROM long l LEFT JOIN sites s ON l.UID = s.UID AND l.SITE_ID = s.SITE_ID"""
)
def source_coastal_profile_2015(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light as percent of the surface light of the same row; the site table's depth wins."""
    raw = spark.sql(_PROFILE, events=table(spark, sf_dir, "events")).withColumnRenamed("STATION_DEPTH_FILE", "stationDepth")
    out = coastal.profile_2015(raw, _sites(spark, sf_dir), _lookups(spark, coastal=NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDate", "sampleDepth", "ANALYTE", "CodeName", "ReportedUnits", steady("RESULT").alias("RESULT"), "QAcomment",
        "stationDepth", "Latitude",
    )


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coastal.sites_2015(spark.sql(_COAST_SITES, orders=table(spark, sf_dir, "orders")))


_SECCHI = """SELECT CAST(o_orderkey AS DOUBLE) AS UID, CASE WHEN o_orderkey % 50 = 0 THEN 'GLNS15-1340' ELSE 'S' || (o_orderkey % 40) END AS SITE_ID,
  CAST(1 + o_custkey % 2 AS INTEGER) AS VISIT_NO, 42000e0 + o_orderkey % 300 AS DATE_COL, 3e0 AS STATION_DEPTH,
  CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice / 20000 END AS DISAPPEARS, CASE WHEN o_orderkey % 7 > 1 THEN o_totalprice / 25000 END AS REAPPEARS,
  CASE o_orderkey % 9 WHEN 0 THEN 'Reading MISSING for this site' WHEN 1 THEN 'clear' WHEN 2 THEN 'unavailable for this site.' END AS SECCHI_COMMENT
FROM {orders}"""
_SECCHI_SQL = f"""secchi AS (
  SELECT UID, SITE_ID, DATE '1899-12-30' + CAST(floor(DATE_COL + CASE WHEN SITE_ID = 'GLNS15-1340' AND VISIT_NO = 1 THEN 1 ELSE 0 END) AS INTEGER) AS d,
         list_avg(list_filter([DISAPPEARS, REAPPEARS], lambda x: x IS NOT NULL)) AS RESULT
  FROM ({_SECCHI.format(orders='orders')})
  WHERE coalesce(DISAPPEARS, REAPPEARS) IS NOT NULL
    AND (SECCHI_COMMENT IS NULL OR NOT regexp_matches(SECCHI_COMMENT, '(?i)missing for this site|unavailable for this site')))"""


@query(
    f"""WITH {_SITES_SQL}, {_SECCHI_SQL}
SELECT c.UID, c.SITE_ID, d AS sampleDate, 'Secchi' AS CodeName, 'm' AS ReportedUnits, {steady_sql('RESULT')} AS RESULT, s.STATION_DEPTH AS stationDepth,
  CASE WHEN RESULT >= s.STATION_DEPTH THEN 'CTB' END AS QAcode, CASE WHEN RESULT >= s.STATION_DEPTH THEN 'Secchi clear to bottom' END AS QAcomment
FROM secchi c LEFT JOIN sites s ON c.UID = s.UID AND c.SITE_ID = s.SITE_ID"""
)
def source_coastal_secchi_2015(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of two readings; one visit was recorded a day early."""
    raw = spark.sql(_SECCHI, orders=table(spark, sf_dir, "orders"))
    out = coastal.secchi_2015(raw, _sites(spark, sf_dir), _lookups(spark, coastal=NAMES))
    return out.select("UID", "SITE_ID", "sampleDate", "CodeName", "ReportedUnits", steady("RESULT").alias("RESULT"), "stationDepth", "QAcode", "QAcomment")


_CHEMISTRY_2010 = """SELECT CAST(l_orderkey AS DOUBLE) AS UID, CASE WHEN l_suppkey % 5 = 0 THEN 'FL' || (l_orderkey % 40) ELSE 'NCCAGL' || (l_orderkey % 40) END AS SITE_ID,
  month(l_shipdate) || '/' || day(l_shipdate) || '/' || year(l_shipdate) AS DATE_COL,
  CASE l_linenumber % 4 WHEN 0 THEN 'CHLA' WHEN 1 THEN 'PTL' WHEN 3 THEN 'SiO2' END AS PARAMETER,
  CASE l_linenumber % 4 WHEN 0 THEN 'Chlorophyll A' WHEN 1 THEN 'Phosphorus' WHEN 2 THEN 'Salinity' END AS PARAMETER_NAME,
  l_quantity AS RESULT, l_discount AS MDL, l_tax AS MRL, CAST(NULL AS STRING) AS METHOD, CASE WHEN l_partkey % 3 = 0 THEN 'Q' END AS QACODE,
  CASE WHEN l_linenumber % 4 = 1 THEN 'mg/L' ELSE 'ug/L' END AS UNITS FROM {lineitem}"""


@query(
    f"""SELECT UID, SITE_ID, CAST(strptime(DATE_COL, '%m/%d/%Y') AS DATE) AS sampleDate, sampleDepth, CodeName, ReportedUnits,
  {steady_sql('RESULT * f')} AS RESULT, {steady_sql('MDL * f')} AS MDL, {steady_sql('MRL * f')} AS MRL, QACODE AS QAcode FROM (
  SELECT *, 5e-1 AS sampleDepth, CASE PARAMETER WHEN 'CHLA' THEN 'Chla' ELSE 'Tot_P' END AS CodeName, lower(replace(UNITS, '/', '')) AS ReportedUnits,
         CASE PARAMETER WHEN 'PTL' THEN 1000e0 ELSE 1e0 END AS f
  FROM ({_duck(_CHEMISTRY_2010).format(lineitem='lineitem')}) WHERE contains(SITE_ID, 'GL') AND PARAMETER IN ('CHLA', 'PTL'))"""
)
def source_coastal_chemistry_2010(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by parameter and code; what the name table lacks goes, and so does what it removes."""
    raw = spark.sql(_CHEMISTRY_2010, lineitem=table(spark, sf_dir, "lineitem"))
    out = coastal.chemistry_2010(raw, _lookups(spark, coastal=NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDate", "sampleDepth", "CodeName", "ReportedUnits", *[steady(c).alias(c) for c in ("RESULT", "MDL", "MRL")], "QAcode"
    )


_CHEMISTRY_2020 = """SELECT CAST(l_orderkey AS DOUBLE) AS UID, 'S' || (l_orderkey % 40) AS SITE_ID, 'L' || (l_orderkey % 3) AS LAB,
  CASE l_linenumber WHEN 1 THEN 'NITRITE_N' WHEN 2 THEN 'NITRATE_N' WHEN 3 THEN 'CHLA' WHEN 4 THEN 'PTL' WHEN 5 THEN 'NITRATE_NITRITE_N' ELSE 'COND' END AS ANALYTE,
  (1 + l_orderkey % 12) || '/' || (1 + l_orderkey % 28) || '/2020' AS DATE_COL, CASE WHEN l_suppkey % 2 = 0 THEN l_tax END AS RL,
  CASE WHEN l_suppkey % 3 > 0 THEN l_discount END AS MDL, CASE WHEN l_partkey % 6 > 0 THEN l_quantity END AS RESULT,
  CASE WHEN l_linenumber = 3 THEN l_returnflag END AS NARS_FLAG, CASE WHEN l_linenumber = 3 THEN l_linestatus END AS NARS_COMMENT
FROM {lineitem}"""
_SUM_2020 = ", ".join(
    f"coalesce(avg({c}) FILTER (ANALYTE = 'NITRATE_NITRITE_N'), avg({c}) FILTER (ANALYTE = 'NITRITE_N') + avg({c}) FILTER (ANALYTE = 'NITRATE_N')) * 1000 AS {c}"
    for c in ("RESULT", "MDL", "RL")
)


@query(
    f"""WITH {_SITES_SQL}, raw AS (SELECT * FROM ({_duck(_CHEMISTRY_2020).format(lineitem='lineitem')})),
sums AS (
  SELECT UID, SITE_ID, LAB, DATE_COL, 'Diss_NOx' AS CodeName, {_SUM_2020}, 'NA' AS QAcode, 'NA' AS QAcomment
  FROM raw WHERE ANALYTE IN ('NITRITE_N', 'NITRATE_N', 'NITRATE_NITRITE_N') GROUP BY UID, SITE_ID, LAB, DATE_COL
  UNION ALL SELECT UID, SITE_ID, LAB, DATE_COL, 'Chla', RESULT, MDL, RL, NARS_FLAG, NARS_COMMENT FROM raw WHERE ANALYTE = 'CHLA')
SELECT c.UID, c.SITE_ID, CAST(strptime(DATE_COL, '%m/%d/%Y') AS DATE) AS sampleDate, CodeName, {steady_sql('RESULT')} AS RESULT,
  {steady_sql('MDL')} AS MDL, {steady_sql('RL')} AS RL, QAcode, QAcomment, s.LAT_DD83 AS Latitude
FROM sums c JOIN sites s ON c.UID = s.UID AND c.SITE_ID = s.SITE_ID"""
)
def source_coastal_chemistry_2020(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reported nitrite-plus-nitrate wins over the sum of the two; samples off the site table go."""
    raw = spark.sql(_CHEMISTRY_2020, lineitem=table(spark, sf_dir, "lineitem"))
    out = coastal.chemistry_2020(raw, _sites(spark, sf_dir), _lookups(spark, coastal=NAMES))
    return out.select(
        "UID", "SITE_ID", "sampleDate", "CodeName", *[steady(c).alias(c) for c in ("RESULT", "MDL", "RL")], "QAcode", "QAcomment", "Latitude"
    )
