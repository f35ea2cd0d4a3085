"""Queries: names, units, limits, flags, sites and derived parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import site_key, unit_text
from ..operators import flags as fl
from ..operators import harmonize as hz
from ..operators.groups import fill_group_mean
from ..operators.joins import null_safe_join
from .catalog import observations, query, steady, steady_sql, table, with_obs
from .lookups import (
    CONVERSIONS,
    FLAGS,
    KEY,
    LIMITS,
    NAME_MAP,
    SITE_ALIASES,
    lookup,
    lookup_sql,
)

_ON = ["ANALYTE", "METHOD"]
_MAP_JOIN = (
    "LEFT JOIN name_map n ON o.ANALYTE IS NOT DISTINCT FROM n.ANALYTE "
    "AND o.METHOD IS NOT DISTINCT FROM n.METHOD"
)
_KEEP = "(n.CodeName IS NULL OR NOT regexp_matches(n.CodeName, '(?i)remove'))"
NAMED = f""",
name_map AS ({lookup_sql(NAME_MAP)}),
keys AS (SELECT CodeName, lower(replace(Units, '/', '')) AS TargetUnits, LongName, Category,
                Explicit_Units FROM ({lookup_sql(KEY)})),
conv AS (SELECT DISTINCT ReportedUnits, TargetUnits, CAST(ConversionFactor AS DOUBLE) AS ConversionFactor
         FROM ({lookup_sql(CONVERSIONS)})),
named AS (SELECT o.*, n.CodeName FROM obs o {_MAP_JOIN} WHERE {_KEEP}),
keyed AS (SELECT m.* EXCLUDE (UNITS), k.* EXCLUDE (CodeName),
                 CASE WHEN lower(replace(m.UNITS, '/', '')) = '%' THEN 'percent'
                      ELSE lower(replace(m.UNITS, '/', '')) END AS ReportedUnits
          FROM named m LEFT JOIN keys k ON m.CodeName IS NOT DISTINCT FROM k.CodeName),
unified AS (SELECT k.* EXCLUDE (RESULT), c.ConversionFactor,
                   coalesce(k.RESULT * c.ConversionFactor, k.RESULT) AS RESULT
            FROM keyed k LEFT JOIN conv c ON k.ReportedUnits IS NOT DISTINCT FROM c.ReportedUnits
                                         AND k.TargetUnits IS NOT DISTINCT FROM c.TargetUnits)
"""


def in_common_units(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Observations with code names, target units and converted results."""
    named = hz.map_names(df, hz.prepare_name_map(lookup(spark, NAME_MAP)), _ON)
    named = named.withColumn("ReportedUnits", unit_text("UNITS")).drop("UNITS")
    named = hz.respell_units(named, {"%": "percent"})
    keyed = hz.add_key(named, hz.prepare_key(lookup(spark, KEY)))
    return hz.convert_units(keyed, hz.prepare_conversions(lookup(spark, CONVERSIONS)))


_UNIT_COLUMNS = (
    "uid, Study, ANALYTE, CodeName, LongName, Category, ReportedUnits, TargetUnits, "
    "ConversionFactor, RESULT"
)


@query(with_obs(NAMED + f"SELECT {_UNIT_COLUMNS} FROM unified"))
def harmonize_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_common_units(spark, observations(spark, sf_dir)).select(*_UNIT_COLUMNS.split(", "))


@query(
    with_obs(
        f""", name_map AS ({lookup_sql(NAME_MAP)})
SELECT o.ANALYTE, o.METHOD, n.CodeName, count(*) AS n, count(o.RESULT) AS known
FROM obs o {_MAP_JOIN} GROUP BY ALL"""
    )
)
def null_safe_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = null_safe_join(observations(spark, sf_dir), lookup(spark, NAME_MAP), _ON)
    return joined.groupBy(*_ON, "CodeName").agg(
        F.count("*").alias("n"), F.count("RESULT").alias("known")
    )


@query(
    with_obs(
        f""", name_map AS ({lookup_sql(NAME_MAP)}),
m AS (SELECT o.*, n.CodeName FROM obs o {_MAP_JOIN})
SELECT 'keep unmapped' AS rule, CodeName, count(*) AS n FROM m n WHERE {_KEEP} GROUP BY ALL
UNION ALL
SELECT 'strict' AS rule, CodeName, count(*) AS n FROM m WHERE CodeName <> 'Remove' GROUP BY ALL"""
    )
)
def map_drop_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = hz.prepare_name_map(lookup(spark, NAME_MAP))
    obs = observations(spark, sf_dir)
    parts = [
        hz.map_names(obs, names, _ON, strict=strict)
        .groupBy("CodeName")
        .agg(F.count("*").alias("n"))
        .select(F.lit(label).alias("rule"), "CodeName", "n")
        for label, strict in (("keep unmapped", False), ("strict", True))
    ]
    return parts[0].unionByName(parts[1])


_APPEND = "concat(coalesce({c}, 'NA'), '; {label}')"


def _limit_sql(source: str, target: str) -> str:
    """The limit-flag rules as a chain of SELECTs from `source` ending in `target`."""
    rules = [
        ("RESULT < MDL", "MDL"),
        ("RESULT < RL", "RL"),
        ("RESULT >= MDL AND RESULT <= RL", "Estimated"),
    ]
    sql, last = "", source
    for i, (cond, label) in enumerate(rules):
        parts = ", ".join(
            f"CASE WHEN {cond} THEN {_APPEND.format(c=c, label=label)} ELSE {c} END AS {c}"
            for c in ("QAcode", "QAcomment")
        )
        sql += f", {target}_{i} AS (SELECT * EXCLUDE (QAcode, QAcomment), {parts} FROM {last})"
        last = f"{target}_{i}"
    over = "CodeName = 'CPAR' AND RESULT > 100"
    surface = _APPEND.format(c="QAcomment", label="Underwater PAR exceeds surface PAR")
    return sql + f""", {target} AS (SELECT * EXCLUDE (QAcode, QAcomment, RESULT),
  CASE WHEN CodeName = 'CPAR' AND RESULT < 0 THEN 0e0 ELSE RESULT END AS RESULT,
  CASE WHEN {over} THEN {_APPEND.format(c='QAcode', label='PAR')} ELSE QAcode END AS QAcode,
  CASE WHEN {over} THEN {surface} ELSE QAcomment END AS QAcomment FROM {last})
"""


_LIMITED = f""", limits AS ({lookup_sql(LIMITS)}),
with_limits AS (SELECT u.*, l.MDL, l.RL FROM unified u LEFT JOIN limits l
                ON u.ANALYTE IS NOT DISTINCT FROM l.ANALYTE){_limit_sql('with_limits', 'limited')}"""


def limited_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = in_common_units(spark, observations(spark, sf_dir))
    return fl.limit_flags(null_safe_join(units, lookup(spark, LIMITS), ["ANALYTE"]))


@query(
    with_obs(NAMED + _LIMITED + "SELECT uid, CodeName, RESULT, MDL, RL, QAcode, QAcomment FROM limited")
)
def limit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limited_observations(spark, sf_dir).select(
        "uid", "CodeName", "RESULT", "MDL", "RL", "QAcode", "QAcomment"
    )


def collapse_sql(source: str, by: list[str], column: str, order: str) -> str:
    """Distinct texts per group in first-seen order, as a subquery."""
    keys = ", ".join(by)
    return (
        f"SELECT {keys}, string_agg(v, ', ' ORDER BY k, v) AS {column} FROM "
        f"(SELECT {keys}, coalesce(CAST({column} AS VARCHAR), 'NA') AS v, min({order}) AS k "
        f"FROM {source} GROUP BY {keys}, v) GROUP BY {keys}"
    )


def flag_join_sql(source: str, target: str) -> str:
    """Flag unification in plain SQL: per-row regex join, then one group per row id."""

    def tidy(field: str) -> str:
        return (
            f"CASE WHEN {field} <> 'NA' THEN replace(replace({field}, 'NA, ', ''), ', NA', '') END"
            f" AS {field}"
        )

    fields = ["Definition", "Unified_Flag", "Unified_Comment", "Retain", "Action"]
    return f""", flag_table AS (
  SELECT Study, coalesce(QAcode, 'XXXX') AS code, coalesce(QAcomment, 'XXXX') AS comment,
         {', '.join(fields)}, min(flag_row) AS flag_row
  FROM ({lookup_sql(FLAGS)}) GROUP BY ALL),
flagged AS (SELECT * EXCLUDE (QAcode, QAcomment),
    regexp_replace(replace(QAcode, ',', ';'), '^NA; ', '') AS QAcode,
    regexp_replace(QAcomment, '^NA; ', '') AS QAcomment
  FROM {source} WHERE QAcode IS NOT NULL OR QAcomment IS NOT NULL),
texts AS (SELECT *,
    coalesce(nullif(regexp_replace(QAcode, '\\s', '', 'g'), '') || ';XXXX', 'XXXX') AS c,
    coalesce(nullif(regexp_replace(QAcomment, '^; ', ''), '') || '; XXXX', 'XXXX') AS m
  FROM flagged),
hits AS (SELECT t.uid, {', '.join('x.' + f for f in fields)}, x.flag_row
  FROM texts t LEFT JOIN flag_table x ON t.Study = x.Study
   AND regexp_matches(t.c, x.code) AND regexp_matches(t.m, x.comment)),
collapsed AS (SELECT f.*, {', '.join(f'{x}.{x}' for x in fields)} FROM flagged f
  {' '.join(f"JOIN ({collapse_sql('hits', ['uid'], x, 'flag_row')}) {x} ON f.uid = {x}.uid" for x in fields)}),
{target} AS (
  SELECT * EXCLUDE (Unified_Flag, Unified_Comment), {tidy('Unified_Flag')}, {tidy('Unified_Comment')}
  FROM collapsed WHERE NOT regexp_matches(Retain, '(?i)remove')
  UNION ALL BY NAME
  SELECT * FROM {source} WHERE QAcode IS NULL AND QAcomment IS NULL)
"""


_FLAG_COLUMNS = (
    "uid, Study, QAcode, QAcomment, Definition, Unified_Flag, Unified_Comment, Retain, Action"
)


@query(with_obs(flag_join_sql("obs", "done") + f"SELECT {_FLAG_COLUMNS} FROM done"))
def unify_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.unify_flags(observations(spark, sf_dir), lookup(spark, FLAGS)).select(
        *_FLAG_COLUMNS.split(", ")
    )


CENSORED_SQL = """CASE WHEN Unified_Flag IS NULL THEN RESULT WHEN contains(Unified_Flag, 'N') THEN NULL
 WHEN contains(Unified_Flag, 'E') THEN RESULT WHEN contains(Unified_Flag, 'R') THEN NULL
 WHEN contains(Unified_Flag, 'B') THEN NULL ELSE RESULT END"""


@query(
    with_obs(
        flag_join_sql("obs", "done")
        + f"SELECT uid, Unified_Flag, {CENSORED_SQL} AS RESULT FROM done"
    )
)
def censor_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = fl.unify_flags(observations(spark, sf_dir), lookup(spark, FLAGS))
    return unified.select("uid", "Unified_Flag", fl.censor().alias("RESULT"))


@query(
    """SELECT doc_id, CASE WHEN r = '' THEN NULL ELSE r END AS QAcomment,
  CASE WHEN c <> 'NA' THEN c END AS QAcode FROM (
  SELECT doc_id,
    replace(replace(regexp_replace(text0, ';$', ''), 'NA;', ''), ': ', '') AS r,
    replace(replace(replace(regexp_replace(regexp_replace(code0, ',', ';'), ';$', ''), 'NA;', ''), ';', ','), ' ', '') AS c
  FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'NA;' || source || ';'
                            WHEN doc_id % 3 = 1 THEN source || ',' || lang || '; X'
                            WHEN doc_id % 5 = 0 THEN 'NA' END AS code0,
               CASE WHEN doc_id % 4 = 0 THEN 'NA;' || text ELSE text END AS text0
        FROM documents))"""
)
def qa_text_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    code = F.expr(
        "CASE WHEN doc_id % 3 = 0 THEN 'NA;' || source || ';' "
        "WHEN doc_id % 3 = 1 THEN source || ',' || lang || '; X' WHEN doc_id % 5 = 0 THEN 'NA' END"
    )
    comment = F.expr("CASE WHEN doc_id % 4 = 0 THEN 'NA;' || text ELSE text END")
    return fl.clean_qa_text(
        docs.select("doc_id", code.alias("QAcode"), comment.alias("QAcomment"))
    )


@query(
    with_obs(
        """, pieces AS (SELECT DISTINCT Study, code, comment FROM (
  SELECT Study, code, unnest(CASE WHEN QAcomment IS NULL THEN [NULL] ELSE string_split(QAcomment, ';') END) AS comment
  FROM (SELECT Study, QAcomment, unnest(CASE WHEN QAcode IS NULL THEN [NULL] ELSE string_split_regex(QAcode, '[;,]') END) AS code
        FROM (SELECT DISTINCT Study, QAcode, QAcomment FROM obs)))),
tidy AS (SELECT Study, trim(replace(code, 'NA,', '')) AS c,
                trim(regexp_replace(replace(comment, 'NA,', ''), ',? NA', '', 'g')) AS m FROM pieces)
SELECT DISTINCT Study, c AS QAcode, m AS QAcomment FROM tidy WHERE c IS NOT NULL OR m IS NOT NULL"""
    )
)
def flag_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.flag_vocabulary(observations(spark, sf_dir))


@query(
    with_obs(
        """SELECT uid, ANALYTE, CASE WHEN ANALYTE IN ('Silicon, Elemental', 'Silica, Dissolved as Si')
      THEN RESULT * CAST('2.13918214' AS DOUBLE) ELSE RESULT END AS RESULT
FROM (SELECT uid, RESULT, CASE ANALYTE WHEN 'click' THEN 'Silicon, Elemental'
      WHEN 'view' THEN 'Silica, Dissolved as Si' ELSE ANALYTE END AS ANALYTE FROM obs)"""
    )
)
def silicon_to_silica(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr(
        "CASE ANALYTE WHEN 'click' THEN 'Silicon, Elemental' "
        "WHEN 'view' THEN 'Silica, Dissolved as Si' ELSE ANALYTE END"
    )
    obs = observations(spark, sf_dir).withColumn("ANALYTE", name)
    return obs.select("uid", "ANALYTE", hz.silicon_to_silica("RESULT").alias("RESULT"))


@query(
    with_obs(
        """, counted AS (SELECT ANALYTE, METHOD, UNITS, count(*) AS n FROM obs GROUP BY ALL),
best AS (SELECT ANALYTE, METHOD, UNITS AS mode_unit FROM counted
         QUALIFY row_number() OVER (PARTITION BY ANALYTE, METHOD ORDER BY n DESC, UNITS) = 1)
SELECT o.uid, CASE WHEN o.UNITS = 'none' THEN b.mode_unit ELSE o.UNITS END AS UNITS
FROM obs o LEFT JOIN best b ON o.ANALYTE IS NOT DISTINCT FROM b.ANALYTE
                           AND o.METHOD IS NOT DISTINCT FROM b.METHOD"""
    )
)
def fill_group_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = {"MEDIUM": F.lit("water"), "FRACTION": F.lit(None).cast("string"), "YEAR": F.lit("2024")}
    obs = observations(spark, sf_dir).withColumns(extra)
    return hz.fill_unknown_unit(obs).select("uid", "UNITS")


@query(
    with_obs(
        NAMED
        + """, bare AS (SELECT uid, CodeName, RESULT, CASE WHEN uid % 2 = 0 THEN QAcomment END AS QAcomment FROM unified)
SELECT uid, CodeName,
  CASE WHEN QAcomment IS NULL AND ((RESULT = 0 AND CodeName IN ('SRP','Diss_P','Chla','Diss_NHx'))
        OR (RESULT < 0 AND CodeName IN ('Tot_P','SRP','Diss_NHx','Diss_P','Chla')))
       THEN 'Method Detection Limit, less than' ELSE QAcomment END AS QAcomment,
  CASE WHEN CodeName = 'Turb_NTU' AND RESULT < 0 THEN 0e0 ELSE RESULT END AS RESULT
FROM bare"""
    )
)
def zero_negative_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = in_common_units(spark, observations(spark, sf_dir))
    comment = F.when(F.col("uid") % 2 == 0, F.col("QAcomment"))
    return hz.zero_negative_rule(
        obs.select("uid", "CodeName", "RESULT", comment.alias("QAcomment"))
    )


_VISITS = """SELECT o_orderkey AS uid, 'S' || (o_custkey % 50) AS SITE_ID,
  CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice / 4e4 END AS DISAPPEARS,
  CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice / 5e4 END AS REAPPEARS,
  5e0 + (o_custkey % 11) AS stationDepth FROM {orders}"""


@query(
    f"""WITH v AS ({_VISITS.format(orders='orders')}),
r AS (SELECT uid, SITE_ID, stationDepth,
        CASE WHEN DISAPPEARS IS NULL THEN REAPPEARS WHEN REAPPEARS IS NULL THEN DISAPPEARS
             ELSE (DISAPPEARS + REAPPEARS) / 2 END AS RESULT FROM v)
SELECT uid, SITE_ID, stationDepth, {steady_sql('RESULT')} AS RESULT,
  CASE WHEN RESULT >= stationDepth THEN 'CTB' END AS QAcode,
  CASE WHEN RESULT >= stationDepth THEN 'Secchi clear to bottom' END AS QAcomment
FROM r WHERE RESULT IS NOT NULL"""
)
def secchi_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = spark.sql(_VISITS, orders=table(spark, sf_dir, "orders"))
    means = hz.secchi_mean(visits, ["uid", "SITE_ID", "stationDepth"], ["DISAPPEARS", "REAPPEARS"])
    marked = hz.clear_to_bottom(means, F.col("RESULT") >= F.col("stationDepth"))
    return marked.select(
        "uid", "SITE_ID", "stationDepth", steady("RESULT").alias("RESULT"), "QAcode", "QAcomment"
    )


_LAB_LIMITS = """SELECT uid, Study, ANALYTE, METHOD, 'water' AS MEDIUM, CAST(NULL AS STRING) AS FRACTION,
 CAST(2020 + uid % 4 AS STRING) AS YEAR,
 CASE uid % 3 WHEN 0 THEN 'Spring' WHEN 1 THEN 'Summer' END AS SEASON, UNITS,
 CASE WHEN uid % 6 = 0 THEN '<' || CAST(sampleDepth AS INT) ELSE CAST(sampleDepth AS STRING) END AS VALUE,
 CASE WHEN uid % 6 = 0 THEN 'below Reporting Limit' END AS RESULT_REMARK FROM {obs}"""


@query(
    with_obs(
        f""", lab AS ({_LAB_LIMITS.format(obs='obs').replace('STRING', 'VARCHAR')}),
name_map AS ({lookup_sql(NAME_MAP)}),
keys AS (SELECT CodeName, lower(replace(Units, '/', '')) AS TargetUnits FROM ({lookup_sql(KEY)})),
conv AS (SELECT DISTINCT ReportedUnits, TargetUnits, CAST(ConversionFactor AS DOUBLE) AS f FROM ({lookup_sql(CONVERSIONS)})),
o AS (SELECT * FROM lab WHERE starts_with(VALUE, '<'))
SELECT DISTINCT CAST(o.YEAR AS DOUBLE) AS YEAR, o.SEASON, n.CodeName,
  coalesce(CAST(replace(o.VALUE, '<', '') AS DOUBLE) * c.f, CAST(replace(o.VALUE, '<', '') AS DOUBLE)) AS rl
FROM o {_MAP_JOIN} LEFT JOIN keys k ON n.CodeName IS NOT DISTINCT FROM k.CodeName
LEFT JOIN conv c ON lower(replace(o.UNITS, '/', '')) IS NOT DISTINCT FROM c.ReportedUnits
  AND k.TargetUnits IS NOT DISTINCT FROM c.TargetUnits"""
    )
)
def less_than_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = spark.sql(_LAB_LIMITS, obs=observations(spark, sf_dir))
    return hz.less_than_limits(
        lab,
        hz.prepare_name_map(lookup(spark, NAME_MAP)),
        hz.prepare_key(lookup(spark, KEY)),
        hz.prepare_conversions(lookup(spark, CONVERSIONS)),
        _ON,
    )


# A season sheet made from the orders table: one row per season and year.
_SEASON_SHEET = """SELECT CASE WHEN month(o_orderdate) <= 6 THEN 'Spring ' ELSE 'Summer ' END
    || year(o_orderdate) AS "Survey (Units)",
  CAST(CAST(floor(avg(o_totalprice)) AS BIGINT) AS STRING) AS "Total Phosphorus (ug/l)",
  CAST(CASE WHEN year(o_orderdate) % 2 = 0 THEN 0 ELSE count(*) END AS STRING) AS "Dissolved Silica (as Si) (mg/l)",
  CAST(min(o_custkey) AS STRING) AS "Chlorophyll (ug/l)"
FROM {orders} GROUP BY month(o_orderdate) <= 6, year(o_orderdate)"""
_LIMIT_NAMES = (
    "ANALYTE VARCHAR, CodeName VARCHAR",
    [("Total Phosphorus", "Tot_P"), ("Dissolved Silica", "Diss_SiO2"), ("Chlorophyll", "Chla")],
)


def _season_rows() -> str:
    sheet = _SEASON_SHEET.format(orders="orders").replace("STRING", "VARCHAR")
    return f"""WITH sheet AS ({sheet}),
grid AS (SELECT s.SEASON, CAST(y.YEAR AS DOUBLE) AS YEAR FROM (VALUES ('Spring'), ('Summer')) AS s(SEASON),
         generate_series(1983, 2012) AS y(YEAR)),
parts AS (SELECT split_part("Survey (Units)", ' ', 1) AS SEASON,
          CAST(split_part("Survey (Units)", ' ', 2) AS DOUBLE) AS YEAR, * EXCLUDE ("Survey (Units)") FROM sheet),
wide AS (SELECT coalesce(p.SEASON, g.SEASON) AS SEASON, coalesce(p.YEAR, g.YEAR) AS YEAR,
         p.* EXCLUDE (SEASON, YEAR) FROM parts p FULL JOIN grid g ON p.SEASON = g.SEASON AND p.YEAR = g.YEAR),
long AS (
 SELECT SEASON, YEAR, 'Tot_P' AS CodeName, CAST("Total Phosphorus (ug/l)" AS DOUBLE) AS mdl FROM wide
 UNION ALL SELECT SEASON, YEAR, 'Diss_SiO2', CAST("Dissolved Silica (as Si) (mg/l)" AS DOUBLE) FROM wide
 UNION ALL SELECT SEASON, YEAR, 'Chla', CAST("Chlorophyll (ug/l)" AS DOUBLE) FROM wide)
SELECT YEAR, SEASON, CodeName, CASE WHEN CodeName = 'Diss_SiO2' THEN nullif(mdl, 0) * CAST('2.13918214' AS DOUBLE)
       ELSE nullif(mdl, 0) END AS mdl FROM long"""


@query(_season_rows())
def season_limit_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = spark.sql(
        _SEASON_SHEET.replace('"', "`"), orders=table(spark, sf_dir, "orders")
    )
    return hz.season_limits(
        sheet,
        "Survey (Units)",
        lookup(spark, _LIMIT_NAMES),
        hz.prepare_key(lookup(spark, KEY)),
        hz.prepare_conversions(lookup(spark, CONVERSIONS)),
        hz.season_grid(spark, ["Spring", "Summer"], 1983, 2012),
    )


_LAB_DEPTHS = """SELECT SITE_ID, CAST(sampleDateTimeUTC AS DATE) AS sampleDate,
  2020 + uid % 3 AS YEAR, CASE WHEN SITE_ID <> 'S3' AND uid % 4 > 0 THEN 20e0 + uid % 50 END AS stationDepth
FROM {obs} WHERE ANALYTE IN ('click', 'view')"""
_CASTS = """SELECT uid, SITE_ID, 2020 + uid % 4 AS YEAR, sampleDepth, CAST(NULL AS DOUBLE) AS stationDepth
FROM {obs} WHERE ANALYTE NOT IN ('click', 'view')"""


@query(
    with_obs(
        f""", lab AS ({_LAB_DEPTHS.format(obs='obs')}), casts AS ({_CASTS.format(obs='obs')}),
deep AS (SELECT SITE_ID, max(sampleDepth) AS d FROM casts GROUP BY ALL),
s AS (SELECT SITE_ID, avg(stationDepth) AS d FROM
      (SELECT DISTINCT SITE_ID, sampleDate, stationDepth FROM lab WHERE stationDepth IS NOT NULL) GROUP BY ALL),
y AS (SELECT SITE_ID, YEAR, avg(stationDepth) AS d FROM
      (SELECT DISTINCT SITE_ID, YEAR, sampleDate, stationDepth FROM lab WHERE stationDepth IS NOT NULL) GROUP BY ALL),
j AS (SELECT c.uid, c.SITE_ID, c.YEAR, coalesce(y.d, s.d) AS known, deep.d AS deepest FROM casts c
  LEFT JOIN s ON c.SITE_ID = s.SITE_ID LEFT JOIN y ON c.SITE_ID = y.SITE_ID AND c.YEAR = y.YEAR
  LEFT JOIN deep ON c.SITE_ID = deep.SITE_ID)
SELECT uid, SITE_ID, YEAR, {steady_sql('coalesce(known, deepest)')} AS stationDepth,
  CASE WHEN known IS NULL AND deepest IS NOT NULL THEN 'D' END AS QAcode,
  CASE WHEN known IS NULL AND deepest IS NOT NULL THEN 'station Depth estimated as the maximum CTD Depth' END AS QAcomment
FROM j"""
    )
)
def site_depth_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    lab, casts = spark.sql(_LAB_DEPTHS, obs=obs), spark.sql(_CASTS, obs=obs)
    casts = hz.with_deepest(casts, ["SITE_ID"], "maxCTDdepth")
    return hz.station_depth_fallback(casts, lab).select(
        "uid", "SITE_ID", "YEAR", steady("stationDepth").alias("stationDepth"), "QAcode", "QAcomment"
    )


_GAPPY = """SELECT uid, SITE_ID, CASE WHEN uid % 3 > 0 AND SITE_ID <> 'S4' THEN Latitude END AS Latitude,
  CASE WHEN uid % 5 > 0 AND SITE_ID <> 'S4' AND SITE_ID <> 'S5' THEN Longitude END AS Longitude FROM {obs}"""
_SITE_TABLE = (
    "SITE_ID VARCHAR, Latitude DOUBLE, Longitude DOUBLE",
    [("S4", 44.0, -87.0), ("S5", 45.5, -86.5), ("S6", 1.0, 1.0)],
)


@query(
    with_obs(
        f""", g AS ({_GAPPY.format(obs='obs')}), t AS ({lookup_sql(_SITE_TABLE)}),
m AS (SELECT SITE_ID, avg(Latitude) AS la, avg(Longitude) AS lo FROM g GROUP BY ALL)
SELECT g.uid, g.SITE_ID, {steady_sql('coalesce(g.Latitude, m.la, t.Latitude)')} AS Latitude,
  {steady_sql('coalesce(g.Longitude, m.lo, t.Longitude)')} AS Longitude
FROM g LEFT JOIN m ON g.SITE_ID = m.SITE_ID LEFT JOIN t ON g.SITE_ID = t.SITE_ID"""
    )
)
def coordinate_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    gappy = spark.sql(_GAPPY, obs=observations(spark, sf_dir))
    filled = hz.fill_coordinates(
        gappy, "SITE_ID", ["Latitude", "Longitude"], lookup(spark, _SITE_TABLE)
    )
    return filled.select(
        "uid", "SITE_ID", steady("Latitude").alias("Latitude"), steady("Longitude").alias("Longitude")
    )


@query(
    with_obs(
        f"""SELECT o.uid, {steady_sql('coalesce(o.RESULT, m.r)')} AS RESULT FROM obs o
LEFT JOIN (SELECT ANALYTE, METHOD, avg(RESULT) AS r FROM obs GROUP BY ALL) m
ON o.ANALYTE = m.ANALYTE AND o.METHOD IS NOT DISTINCT FROM m.METHOD"""
    )
)
def fill_with_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_group_mean(observations(spark, sf_dir), ["ANALYTE", "METHOD"], ["RESULT"])
    return filled.select("uid", steady("RESULT").alias("RESULT"))


# Nitrite and nitrate rows made from order lines: line 1 and 2 of an order.
_NITROGEN = """SELECT l_orderkey AS UID, l_orderkey * 10 + l_linenumber AS ord,
  CASE l_linenumber WHEN 1 THEN 'NITRITE_N' WHEN 2 THEN 'NITRATE_N' ELSE 'CHLA' END AS ANALYTE,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_extendedprice END AS RESULT,
  l_discount AS MDL, CASE WHEN l_suppkey % 2 = 0 THEN l_tax END AS LRL,
  CASE WHEN l_partkey % 3 = 0 THEN l_returnflag END AS METHOD, 'lab' || (l_orderkey % 3) AS LAB,
  l_returnflag AS QAcode, l_linestatus AS QAcomment FROM {lineitem}"""


def _nitrogen_sql() -> str:
    texts = ["METHOD", "QAcode", "QAcomment"]
    joins = " ".join(
        f"JOIN ({collapse_sql('own', ['UID', 'LAB'], c, 'ord')}) {c} ON d.UID = {c}.UID AND d.LAB = {c}.LAB"
        for c in texts
    )
    return f"""WITH src AS ({_NITROGEN.format(lineitem='lineitem')}),
own AS (SELECT * FROM src WHERE ANALYTE IN ('NITRITE_N', 'NITRATE_N')),
d AS (SELECT UID, LAB,
  avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN RESULT END) AS r0, avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN RESULT END) AS r1,
  avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN MDL END) + avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN MDL END) AS MDL,
  avg(CASE WHEN ANALYTE = 'NITRITE_N' THEN LRL END) + avg(CASE WHEN ANALYTE = 'NITRATE_N' THEN LRL END) AS LRL
  FROM own GROUP BY ALL)
SELECT d.UID, d.LAB, 'Diss_NOx' AS ANALYTE, {steady_sql('r0 + r1', 4)} AS RESULT, {steady_sql('MDL')} AS MDL,
  {steady_sql('LRL')} AS LRL, nullif(METHOD.METHOD, 'NA') AS METHOD, QAcode.QAcode, QAcomment.QAcomment
FROM d {joins} WHERE (r0 IS NULL) = (r1 IS NULL)
UNION ALL
SELECT UID, LAB, ANALYTE, {steady_sql('RESULT', 4)}, {steady_sql('MDL')}, {steady_sql('LRL')}, METHOD, QAcode, QAcomment
FROM src WHERE ANALYTE = 'CHLA'"""


@query(_nitrogen_sql())
def sum_two_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_NITROGEN, lineitem=table(spark, sf_dir, "lineitem"))
    out = hz.oxidised_nitrogen(
        rows, ["UID", "LAB"], "ord", texts=("METHOD", "QAcode", "QAcomment")
    )
    return out.select(
        "UID", "LAB", "ANALYTE", steady("RESULT", 4).alias("RESULT"), steady("MDL").alias("MDL"),
        steady("LRL").alias("LRL"), "METHOD", "QAcode", "QAcomment",
    )


_LIGHT = """SELECT uid, SITE_ID, sampleDepth, UNITS, QAcode,
  CASE WHEN ANALYTE = 'click' AND sampleDepth >= 58 OR ANALYTE = 'view' AND sampleDepth = 60 THEN 0e0 ELSE abs(RESULT) END AS RESULT,
  CASE ANALYTE WHEN 'click' THEN 'Ambient PAR' WHEN 'view' THEN 'Underwater PAR' ELSE ANALYTE END AS ANALYTE
FROM {obs}"""


def _light_sql() -> str:
    by = ["SITE_ID", "sampleDepth"]
    return f""", src AS ({_LIGHT.format(obs='obs')}),
own AS (SELECT * FROM src WHERE ANALYTE IN ('Ambient PAR', 'Underwater PAR')),
d AS (SELECT SITE_ID, sampleDepth, avg(CASE WHEN ANALYTE = 'Ambient PAR' THEN RESULT END) AS a,
      avg(CASE WHEN ANALYTE = 'Underwater PAR' THEN RESULT END) AS u FROM own GROUP BY ALL)
SELECT SITE_ID, sampleDepth, 'Corrected PAR' AS ANALYTE, 'percent' AS UNITS,
  {steady_sql('100 * (u / nullif(a, 0))')} AS RESULT, a = 0 AS endless, QAcode
FROM d JOIN ({collapse_sql('own', by, 'QAcode', 'uid')}) USING (SITE_ID, sampleDepth)
WHERE CASE WHEN a = 0 THEN u <> 0 ELSE u / nullif(a, 0) IS NOT NULL END
UNION ALL SELECT SITE_ID, sampleDepth, ANALYTE, UNITS, {steady_sql('RESULT')}, false, QAcode
FROM src WHERE ANALYTE NOT IN ('Ambient PAR', 'Underwater PAR')"""


@query(with_obs(_light_sql()))
def cond_mean_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_LIGHT, obs=observations(spark, sf_dir))
    out = hz.surface_light_percent(rows, ["SITE_ID", "sampleDepth"], "uid", texts=("QAcode",))
    endless = F.coalesce(F.abs("RESULT") == float("inf"), F.lit(False))
    return out.select(
        "SITE_ID", "sampleDepth", "ANALYTE", "UNITS",
        F.when(~endless, steady("RESULT")).alias("RESULT"), endless.alias("endless"), "QAcode",
    )


@query(
    with_obs(
        f""", a AS ({lookup_sql(SITE_ALIASES)})
SELECT o.uid, a.SITE_ID FROM (SELECT uid, CASE uid % 3 WHEN 0 THEN 'Leg ' || SITE_ID
   WHEN 1 THEN '#' || SITE_ID ELSE SITE_ID END AS raw FROM obs) o
JOIN a ON replace(replace(replace(lower(o.raw), ' ', ''), 'leg', ''), '#', '') = a.alias
WHERE a.Keep = 'T'"""
    )
)
def site_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "CASE uid % 3 WHEN 0 THEN 'Leg ' || SITE_ID WHEN 1 THEN '#' || SITE_ID ELSE SITE_ID END"
    )
    obs = observations(spark, sf_dir).select("uid", raw.alias("SITE_ID"))
    aliases = lookup(spark, SITE_ALIASES).withColumnRenamed("alias", "Other.names")
    return hz.resolve_alias(obs, aliases).select("uid", "SITE_ID")


@query(
    """SELECT s_suppkey, CASE WHEN starts_with(n, 'pwa') THEN 'pw' || substr(n, 4)
       WHEN starts_with(n, 'lvd') THEN 'lud' || substr(n, 4) ELSE n END AS SITE_ID
FROM (SELECT s_suppkey, replace(lower(CASE s_suppkey % 3 WHEN 0 THEN 'PWA_' WHEN 1 THEN 'LVD' ELSE 'pw' END || s_suppkey), '_', '') AS n
      FROM supplier)"""
)
def site_typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "CASE s_suppkey % 3 WHEN 0 THEN 'PWA_' WHEN 1 THEN 'LVD' ELSE 'pw' END || s_suppkey"
    )
    sites = table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("SITE_ID"))
    fixed = hz.fix_site_typos("SITE_ID", {"pwa": "pw", "lvd": "lud"})
    return sites.select("s_suppkey", fixed.alias("SITE_ID"))


@query(
    """WITH a AS (SELECT *, s_nationkey = 5 AND contains(s_name, '1') AS h1 FROM supplier),
b AS (SELECT s_suppkey, s_name, CASE WHEN h1 THEN 6 ELSE s_nationkey END AS s_nationkey,
             CASE WHEN h1 THEN 110e0 ELSE s_acctbal END AS s_acctbal FROM a)
SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_nationkey = 6 AND s_acctbal > 100 THEN 45e0 ELSE s_acctbal END AS s_acctbal FROM b"""
)
def point_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        hz.Correction(
            (F.col("s_nationkey") == 5) & F.col("s_name").contains("1"),
            {"s_nationkey": 6, "s_acctbal": 110.0},
        ),
        hz.Correction((F.col("s_nationkey") == 6) & (F.col("s_acctbal") > 100), {"s_acctbal": 45.0}),
    ]
    return hz.apply_corrections(table(spark, sf_dir, "supplier"), rules)


_FILES = """SELECT c_custkey, 'raw/2019/' || c_custkey || '_' ||
  CASE c_custkey % 8 WHEN 0 THEN 'MI18MA' WHEN 1 THEN 'MI18MB' WHEN 2 THEN 'MI27M-A' WHEN 3 THEN 'MI30B CAST2'
       WHEN 4 THEN 'MI,2' WHEN 5 THEN 'MIDERIVED' WHEN 6 THEN 'mi' || c_nationkey ELSE 'castMI' END
  || CASE WHEN c_custkey % 2 = 0 THEN '.cnv' ELSE '.BIN' END AS path FROM {customer}"""
_REPEATS = ["MI18MB", "MI27M-B", "MI27MB", "MI41M-B", "MI41MB"]
_FIRST = {"MI18MA": "MI18M", "MI27M-A": "MI27M", "MI27MA": "MI27M", "MI41M-A": "MI41M", "MI41MA": "MI41M"}


@query(
    f"""WITH f AS ({_FILES.format(customer='customer')}),
n AS (SELECT c_custkey, split_part(split_part(regexp_replace(split_part(path, '/', 3), '(?i)[.]cnv|[.]bin', '', 'g'), '_', 2), ' ', 1) AS s FROM f)
SELECT c_custkey, CASE s WHEN 'MI18MA' THEN 'MI18M' WHEN 'MI27M-A' THEN 'MI27M' WHEN 'MI27MA' THEN 'MI27M'
  WHEN 'MI41M-A' THEN 'MI41M' WHEN 'MI41MA' THEN 'MI41M' ELSE s END AS SITE_ID
FROM n WHERE NOT regexp_matches(s, '(?i)cast') AND NOT contains(s, ',') AND NOT regexp_matches(s, '(?i)derive')
 AND s NOT IN ('MI18MB', 'MI27M-B', 'MI27MB', 'MI41M-B', 'MI41MB')"""
)
def first_cast_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spark.sql(_FILES, customer=table(spark, sf_dir, "customer"))
    named = files.select("c_custkey", hz.cast_site("path").alias("SITE_ID"))
    return hz.first_casts(named, "SITE_ID", _REPEATS, _FIRST)


@query(
    """SELECT s.s_suppkey, n.n_name, r.r_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ('AFRICA', 'ASIA')"""
)
def water_body_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return hz.in_water_bodies(joined, ["AFRICA", "ASIA"], "r_name").select(
        "s_suppkey", "n_name", "r_name"
    )


@query(
    with_obs(
        """SELECT uid, Study || '-' || SITE_ID || '-' || coalesce(METHOD, 'NA') || '-' || coalesce(QAcode, 'NA') AS key FROM obs"""
    )
)
def build_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "uid", hz.uid("Study", "SITE_ID", "METHOD", "QAcode").alias("key")
    )


@query(
    with_obs(
        """SELECT uid, CASE WHEN Latitude >= 42 AND Latitude <= 45 THEN Latitude END AS Latitude,
 CASE WHEN RESULT <> 0 THEN RESULT END AS RESULT, lower(replace(Study, '_', '')) AS site FROM obs"""
    )
)
def range_and_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "uid",
        hz.in_plausible_range("Latitude", 42.0, 45.0).alias("Latitude"),
        hz.sentinel_to_null("RESULT", 0.0).alias("RESULT"),
        site_key("Study").alias("site"),
    )


_DUPES = """SELECT s_nationkey AS nation, CAST(NULL AS STRING) AS note, s_acctbal > 0 AS rich FROM {supplier}
UNION ALL SELECT c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, c_acctbal > 0 FROM {customer}"""


@query(
    "SELECT DISTINCT * FROM ("
    + _DUPES.format(supplier="supplier", customer="customer").replace("STRING", "VARCHAR")
    + ")"
)
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(
        _DUPES,
        supplier=table(spark, sf_dir, "supplier"),
        customer=table(spark, sf_dir, "customer"),
    )
    return hz.drop_duplicates(rows)


