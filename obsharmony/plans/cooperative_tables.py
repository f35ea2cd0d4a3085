"""Queries: the cooperative survey pipelines on tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import cooperative
from ..sources import standard as st
from .catalog import query, steady, steady_sql, table
from .lookups import lookup, lookup_sql
from .source_tables import _NAME_SCHEMA, _duck, _joined, _lookups, _names

NAMES = (
    _NAME_SCHEMA,
    _names(st.COOP_2015, {"NH4": "SRP", "Chla": "Chla", "Temptr": "Temp", "TSS": "Remove", "DOC": "Remove"})
    + _names(st.COOP_2021_CHEMISTRY, {"NH4": "SRP", "ch.la": "Chla", "VSS": "remove"})
    + _names(
        st.COOP_2021_CASTS,
        {"Temperature": "Temp", "cpar": "CPAR", "pH": "pH", "Oxygen": "Remove", "SpecificConductance": "Remove",
         "Temp_USGS": "Temp", "cpar_USGS": "CPAR"},
    ),
)

# --- 2015 ------------------------------------------------------------------------

_STATIONS = "SELECT 'N' || n_nationkey AS StationCodeKey, 1e0 AS `DepthM _target`, 44e0 AS LatDD_target, -87e0 AS LonDD_target FROM {nation}"
_EVENTS = """SELECT 'e' || c_custkey AS SampleEventKey, CASE WHEN c_nationkey = 3 THEN 'Man_46' ELSE 'N' || c_nationkey END AS StationCodeFK,
  44e0 + c_custkey % 4 AS LatDD_actual, -87e0 AS LonDD_actual, CAST('2015-05-' || (10 + c_custkey % 20) || ' 00:00:00' AS {ts}) AS SampleDate,
  CAST('1899-12-30 ' || (10 + c_custkey % 14) || ':' || (10 + c_custkey % 50) || ':00' AS {ts}) AS TimeEST, 20e0 + c_custkey % 7 AS DepthM_actual FROM {customer}"""
_LAYERS = """SELECT o_orderkey AS STISkey, 'e' || o_custkey AS SampleEventFK, CAST(o_orderkey % 40 AS DOUBLE) AS WQdepth_m,
  CASE o_orderkey % 6 WHEN 0 THEN 'hyp_cmp' WHEN 1 THEN NULL ELSE 'epi' END AS ASTlayername FROM {orders}"""
_CHEM = """SELECT l_orderkey AS `STIS#`, 'x' AS Chem_site, l_quantity AS NH4_ugNL, CASE WHEN l_discount > 0 THEN l_discount END AS Chla_mgL, l_tax AS TSS_mgL,
  l_tax AS pH FROM {lineitem}"""
_CTD = "SELECT o_orderkey AS STISkey, CAST(o_orderkey % 33 AS DOUBLE) / 2 AS CTDdepth, CASE WHEN o_custkey % 3 > 0 THEN o_totalprice END AS Temptr_C FROM {orders}"
_LIMITS = (
    "WQParam VARCHAR, WQUnits VARCHAR, DetectLimit VARCHAR, Analyst VARCHAR, AnalMethod VARCHAR",
    [("NH4_x", "ugN/L", "2", "Ann", "M1"), ("Chla", "mg/L", "0.5", "Bob", "M2"), ("Temptr", "deg", "0.1", "Cy", "M3"),
     ("DOC", "mg/L", "1", "Di", "M4"), ("Unknown", "mg/L", "1", "Ed", "M5")],
)
_TS = "TIMESTAMP"


@query(
    f"""WITH ev AS ({_EVENTS.replace('{ts}', _TS).format(customer='customer')}), la AS ({_LAYERS.format(orders='orders')}),
sample AS (SELECT la.STISkey AS k, la.WQdepth_m, la.ASTlayername, e.StationCodeFK AS SITE_ID, CASE WHEN e.StationCodeFK = 'Man_46' AND e.LatDD_actual > 46 THEN CAST('44.1116833333333' AS DOUBLE)
    ELSE e.LatDD_actual END AS Latitude, e.DepthM_actual AS stationDepth,
    CAST(e.SampleDate AS DATE) + CAST(e.TimeEST AS TIME) + INTERVAL 5 HOUR AS t
  FROM la LEFT JOIN ev e ON CASE WHEN la.STISkey BETWEEN 5008 AND 5015 THEN 'Fra_46_May_LE2' ELSE la.SampleEventFK END = e.SampleEventKey),
val AS (SELECT l_orderkey AS k, NULL::DOUBLE AS d, 'NH4' AS ANALYTE, 'ugnl' AS u, l_quantity AS RESULT FROM lineitem
  UNION ALL SELECT l_orderkey, NULL, 'Chla', 'mgl', l_discount FROM lineitem WHERE l_discount > 0
  UNION ALL SELECT l_orderkey, NULL, 'pH', NULL, l_tax FROM lineitem
  UNION ALL SELECT o_orderkey, CAST(o_orderkey % 33 AS DOUBLE) / 2, 'Temptr', 'c', o_totalprice FROM orders WHERE o_custkey % 3 > 0),
named AS (SELECT v.*, s.* EXCLUDE (k), m.CodeName FROM val v LEFT JOIN sample s ON v.k = s.k
  LEFT JOIN ({lookup_sql(NAMES)}) m ON m.Study = 'CSMI_2015' AND m.ANALYTE = v.ANALYTE WHERE s.ASTlayername IS NULL OR NOT contains(s.ASTlayername, '_cmp')),
unit AS ({_joined('named', '', "CASE WHEN ANALYTE = 'pH' THEN 'unitless' WHEN u = 'ugnl' THEN 'ug nl' ELSE u END")}),
lim AS (SELECT * FROM (VALUES ('NH4', 'SRP', 2e0, 'Ann', 'M1'), ('Chla', 'Chla', 500e0, 'Bob', 'M2'), ('Temptr', 'Temp', 1e-1, 'Cy', 'M3')) AS l(ANALYTE, CodeName, MDL, LAB, METHOD))
SELECT 'CSMI-' || u.k AS UID, u.SITE_ID, u.Latitude, u.stationDepth, CASE WHEN u.ANALYTE = 'Temptr' THEN u.d ELSE u.WQdepth_m END AS sampleDepth, CAST(u.t AS DATE) AS sampleDate,
  u.t AS sampleDateTime, u.CodeName, u.ANALYTE, u.ReportedUnits, {steady_sql('coalesce(u.RESULT * u.ConversionFactor, u.RESULT)')} AS RESULT, l.MDL, l.LAB, l.METHOD
FROM unit u LEFT JOIN lim l ON u.ANALYTE = l.ANALYTE AND u.CodeName = l.CodeName"""
)
def source_cooperative_2015(spark: SparkSession, sf_dir: str) -> DataFrame:
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    out = cooperative.load_2015(
        spark.sql(_STATIONS, nation=t("nation")),
        spark.sql(_EVENTS.replace("{ts}", "TIMESTAMP_NTZ"), customer=t("customer")),
        spark.sql(_LAYERS, orders=t("orders")),
        lookup(spark, _LIMITS),
        spark.sql(_CHEM, lineitem=t("lineitem")),
        spark.sql(_CTD, orders=t("orders")),
        _lookups(spark, coop=NAMES),
    )
    return out.select(
        "UID", "SITE_ID", "Latitude", "stationDepth", "sampleDepth", "sampleDate", "sampleDateTime", "CodeName", "ANALYTE",
        "ReportedUnits", steady("RESULT").alias("RESULT"), "MDL", "LAB", "METHOD",
    )


# --- 2021 ------------------------------------------------------------------------

_CHEM21 = """SELECT CASE o_custkey % 4 WHEN 0 THEN 'EAS_' WHEN 1 THEN 'pwa' WHEN 2 THEN 'LVD_' ELSE 'sto' END || (o_custkey % 9) AS Site,
  44377e0 + o_custkey % 30 AS Date, CASE o_orderkey % 4 WHEN 0 THEN '3:45 / 4:29' WHEN 1 THEN '0.4375' WHEN 2 THEN '10:05 (CDT)' END AS `Time.(EST)`,
  CASE WHEN o_custkey % 5 > 0 THEN 10e0 + o_custkey % 9 END AS `Site.Depth.(m)`, CAST(o_orderkey % 20 AS DOUBLE) AS `Separate.depths.(m)`, o_orderkey AS `STIS#`,
  CAST(o_custkey % 50 - 5 AS STRING) AS `NH4.ug.N/L`, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey % 40 AS STRING) END AS `chl.a.mg/L`, '1' AS `VSS.mg/L` FROM {orders}"""
_CTD21 = """SELECT 'EAS_' || (user_id % 12) AS X2, 44377e0 + event_id % 3 + 25e-2 AS X3, CAST(event_id % 50 AS DOUBLE) AS `Depth..fresh.water..m.`,
  value AS `Temperature..deg.C.`, 1e0 AS `Oxygen..mg.l.`, 2e0 AS `Specific.Conductance..uS.cm.`, CASE WHEN event_id % 9 = 0 THEN -9.99e-29 WHEN event_id % 4 > 0 THEN value / 4 END AS `CPAR.Corrected.Irradiance....`,
  8e0 AS pH, CASE WHEN event_id % 7 = 0 THEN 12e0 ELSE 43e0 + event_id % 3 END AS `Latitude..deg.`, -87e0 + event_id % 5 AS `Longitude..deg.` FROM {events}"""
_SITES21 = "SELECT 'LUD_' || n_nationkey AS TRANSECT, 43e0 + n_nationkey % 2 AS BEG_LATITUDE_DD, -86e0 AS BEG_LONGITUDE_DD, 30e0 + n_nationkey AS beg_depth FROM {nation}"
_CTDSURVEY = """SELECT 'LUD_' || (c_custkey % 30) AS Transect, 's' || c_custkey AS Serial, (1 + c_custkey % 28) || '-JUL-21' AS Date, CAST(c_custkey % 9 AS DOUBLE) AS Depth_m,
  CASE WHEN c_custkey % 4 > 0 THEN c_acctbal END AS Temp_C FROM {customer}"""
_LIGHT21 = """SELECT 'LUD_' || (event_id % 40) AS Transect, substr(CAST(ts AS STRING), 1, 19) AS Date, 6e0 + (event_id % 70) / 4e0 AS instrument_time,
  CAST(event_id % 17 / 2e0 AS STRING) AS Depth_m, value AS `dc.pc.PAR` FROM {events}"""
_VALUES21 = ["NH4.ug.N/L", "chl.a.mg/L", "VSS.mg/L"]


def _quoted(text: str) -> str:
    return _duck(text).replace("`", '"')


_SITE = "regexp_replace(regexp_replace(replace(lower({c}), '_', ''), '^pwa', 'pw'), '^lvd', 'lud')"


@query(
    f"""WITH chem AS ({_quoted(_CHEM21.format(orders='orders'))}), epa AS ({_quoted(_CTD21.format(events='events'))}),
sv AS ({_quoted(_CTDSURVEY.format(customer='customer'))}), li AS ({_quoted(_LIGHT21.format(events='events'))}),
sites AS (SELECT replace(lower(TRANSECT), '_', '') AS SITE_ID, BEG_LATITUDE_DD AS la, BEG_LONGITUDE_DD AS lo, beg_depth AS sd FROM ({_SITES21.format(nation='nation')})),
c0 AS (SELECT *, DATE '1899-12-30' + CAST(Date AS INTEGER) AS day, CASE WHEN "Time.(EST)" = '3:45 / 4:29' THEN INTERVAL 247 MINUTE WHEN "Time.(EST)" = '0.4375' THEN INTERVAL 630 MINUTE
   WHEN "Time.(EST)" IS NOT NULL THEN INTERVAL 605 MINUTE END AS clock FROM chem),
c1 AS (SELECT *, day + clock + INTERVAL 5 HOUR AS t FROM c0),
cv AS (SELECT 'CSMI_2021_WQ-' || "STIS#" AS UID, 'CSMI_2021_WQ' AS Study, {_SITE.format(c='Site')} AS SITE_ID, t, coalesce(CAST(t AS DATE), day) AS sampleDate, "Site.Depth.(m)" AS sd, "Separate.depths.(m)" AS sampleDepth,
   v.ANALYTE, v.u, v.r, NULL::DOUBLE AS la, NULL::DOUBLE AS lo, NULL::DOUBLE AS deep FROM c1, LATERAL (SELECT 'NH4' AS ANALYTE, 'ug n/l' AS u, CAST("NH4.ug.N/L" AS DOUBLE) AS r UNION ALL SELECT 'chla', 'a mg/l', CAST("chl.a.mg/L" AS DOUBLE)) v WHERE v.r >= 0),
e0 AS (SELECT replace(lower(X2), '_', '') AS SITE_ID, DATE '1899-12-30' + CAST(floor(X3) AS INTEGER) AS sampleDate, "Depth..fresh.water..m." AS sampleDepth, "Temperature..deg.C." AS tt, nullif("CPAR.Corrected.Irradiance....", -9.99e-29) AS cc,
   pH AS pp, CASE WHEN "Latitude..deg." BETWEEN 41 AND 47 THEN "Latitude..deg." END AS la0, CASE WHEN "Longitude..deg." BETWEEN -88 AND -84 THEN "Longitude..deg." END AS lo0 FROM epa),
e1 AS (SELECT SITE_ID, sampleDate, quantile_cont(la0, 0.5) AS la, quantile_cont(lo0, 0.5) AS lo FROM e0 GROUP BY ALL),
e2 AS (SELECT SITE_ID, max(sampleDepth) AS deep FROM e0 GROUP BY ALL),
ev AS (SELECT 'EPActd-' || e0.SITE_ID || '-' || CAST(sampleDepth AS BIGINT) AS UID, 'CSMI_2021_CTD' AS Study, {_SITE.format(c='e0.SITE_ID')} AS SITE_ID, NULL::TIMESTAMP AS t, e0.sampleDate, NULL::DOUBLE AS sd, sampleDepth,
   v.ANALYTE, v.u, v.r, e1.la, e1.lo, e2.deep FROM e0 JOIN e1 ON e0.SITE_ID = e1.SITE_ID AND e0.sampleDate = e1.sampleDate JOIN e2 ON e0.SITE_ID = e2.SITE_ID,
   LATERAL (SELECT 'Temperature' AS ANALYTE, 'c' AS u, tt AS r UNION ALL SELECT 'cpar', 'percent', cc UNION ALL SELECT 'pH', 'unitless', pp) v),
l0 AS (SELECT Transect, CAST(Date AS TIMESTAMP) AS w, instrument_time AS i, round_even(CAST(Depth_m AS DOUBLE), 0) AS sampleDepth, "dc.pc.PAR" AS r FROM li),
l1 AS (SELECT *, date_trunc('day', w) + to_minutes(CAST(floor(i) * 60 + floor(60 * (i - floor(i))) AS BIGINT)) + INTERVAL 5 HOUR AS t FROM l0 WHERE sampleDepth <> 0 AND floor(i) < 24),
l2 AS (SELECT replace(lower(Transect), '_', '') AS SITE_ID, CAST(t AS DATE) AS sampleDate, sampleDepth, avg(r) AS r, min(t) AS t FROM l1 GROUP BY ALL),
uv AS (SELECT 'USGSctd-' || Transect || '_' || Serial AS UID, replace(lower(Transect), '_', '') AS SITE_ID, NULL::TIMESTAMP AS t, CAST(strptime(Date, '%d-%b-%y') AS DATE) AS sampleDate, Depth_m AS sampleDepth, 'Temp_USGS' AS ANALYTE, 'c' AS u, Temp_C AS r FROM sv
   UNION ALL SELECT 'NBpar-' || SITE_ID || '-' || CAST(sampleDepth AS BIGINT), SITE_ID, t, sampleDate, sampleDepth, 'cpar_USGS', 'percent', r FROM l2 WHERE SITE_ID IN (SELECT SITE_ID FROM sites)),
every AS (SELECT UID, Study, SITE_ID, t, sampleDate, sd, sampleDepth, ANALYTE, u, r, la, lo, deep FROM cv UNION ALL SELECT UID, Study, SITE_ID, t, sampleDate, sd, sampleDepth, ANALYTE, u, r, la, lo, deep FROM ev
   UNION ALL SELECT x.UID, 'CSMI_2021_CTD', {_SITE.format(c='x.SITE_ID')}, x.t, x.sampleDate, s.sd, x.sampleDepth, x.ANALYTE, x.u, x.r, s.la, s.lo, NULL FROM uv x LEFT JOIN sites s ON x.SITE_ID = s.SITE_ID),
named AS (SELECT e.*, m.CodeName FROM every e LEFT JOIN ({lookup_sql(NAMES)}) m ON m.Study = e.Study AND replace(m.ANALYTE, '.', '') = e.ANALYTE
   WHERE m.CodeName IS NULL OR NOT regexp_matches(m.CodeName, '(?i)remove')),
mean AS (SELECT SITE_ID, avg(la) AS mla, avg(lo) AS mlo, avg(sd) AS msd FROM named GROUP BY ALL),
placed AS (SELECT n.* EXCLUDE (la, lo, sd), coalesce(n.la, mla) AS Latitude, coalesce(n.lo, mlo) AS Longitude, coalesce(n.sd, msd) AS known FROM named n JOIN mean USING (SITE_ID)),
unit AS ({_joined('placed', '', "replace(u, '/', '')")})
SELECT 'CSMI-' || UID AS UID, Study, SITE_ID, t AS sampleDateTime, sampleDate, sampleDepth, {steady_sql('Latitude')} AS Latitude, {steady_sql('Longitude')} AS Longitude, {steady_sql('coalesce(known, deep)')} AS stationDepth,
  CASE WHEN known IS NULL AND deep IS NOT NULL THEN 'D' END AS QAcode, CodeName, ANALYTE, ReportedUnits, {steady_sql('coalesce(r * ConversionFactor, r)')} AS RESULT,
  CASE WHEN CodeName = 'SRP' THEN 5e-1 WHEN CodeName = 'Chla' THEN 25e-2 END AS MDL FROM unit"""
)
def source_cooperative_2021(spark: SparkSession, sf_dir: str) -> DataFrame:
    def derived(text: str, **names: str) -> DataFrame:
        return spark.sql(text, **{k: table(spark, sf_dir, v) for k, v in names.items()})

    frames = {
        "chemistry": derived(_CHEM21, orders="orders"),
        "limits": spark.sql("SELECT '0.5' AS `NH4.ug.N/L`, '0.25' AS `chl.a.mg/L`"),
        "agency_casts": derived(_CTD21, events="events"),
        "survey_casts": derived(_CTDSURVEY, customer="customer"),
        "survey_sites": derived(_SITES21, nation="nation"),
        "light": derived(_LIGHT21, events="events"),
    }
    out = cooperative.load_2021(frames, _VALUES21, _lookups(spark, coop=NAMES))
    rounded = ["Latitude", "Longitude", "stationDepth", "RESULT"]
    return out.withColumns({c: steady(c) for c in rounded}).select(
        "UID", "Study", "SITE_ID", "sampleDateTime", "sampleDate", "sampleDepth", "Latitude", "Longitude", "stationDepth",
        "QAcode", "CodeName", "ANALYTE", "ReportedUnits", "RESULT", "MDL",
    )
