"""Queries: whole source pipelines and the assembly, on tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import harmonize as hz
from ..operators.joins import null_safe_join
from ..sources import standard as st
from .assemble import FINAL, combine, finish, ordered
from .catalog import observations, query, steady, steady_sql, with_obs
from .harmonisation import CENSORED_SQL, NAMED, _limit_sql, flag_join_sql, in_common_units
from .lookups import FLAGS, LIMITS, lookup, lookup_sql

_LAB = "CodeName IN ('Tot_P', 'Diss_P', 'Chla')"
_STATION = "CASE WHEN SITE_ID NOT IN ('S3', 'S7') AND uid % 4 > 0 THEN 20e0 + uid % 50 END"
_STANDARD = f"""'obs-' || uid AS UID, Study, SITE_ID, Latitude, Longitude, sampleDepth,
  CAST(sampleDateTimeUTC AS DATE) AS sampleDate, CASE WHEN uid % 9 > 0 THEN sampleDateTimeUTC END AS sampleDateTime,
  CodeName, ANALYTE, Category, LongName, Explicit_Units, RESULT, MDL, RL, TargetUnits, ReportedUnits, ConversionFactor,
  METHOD, 2020e0 + uid % 3 AS YEAR"""


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lab rows, cast rows and a second delivery that repeats part of the lab rows."""
    units = in_common_units(spark, observations(spark, sf_dir))
    rows = null_safe_join(units, lookup(spark, LIMITS), ["ANALYTE"])
    lab_rows = spark.sql(
        f"SELECT {_STANDARD}, {_STATION} AS stationDepth, QAcode, QAcomment, uid AS n FROM {{rows}} WHERE {_LAB}",
        rows=rows,
    )
    cast_rows = spark.sql(
        f"SELECT {_STANDARD}, CAST(NULL AS DOUBLE) AS stationDepth FROM {{rows}} WHERE NOT {_LAB}",
        rows=rows,
    )
    lab = st.as_observations(lab_rows, extra=["YEAR"])
    casts = st.as_observations(
        hz.with_deepest(cast_rows, ["SITE_ID"], "maxCTDdepth"), extra=["YEAR", "maxCTDdepth"]
    )
    return lab, casts, st.as_observations(lab_rows.filter("n % 5 = 0"))


def assemble_sql() -> str:
    final = {
        "stationDepth": steady_sql("stationDepth"),
        "sampleDate": "coalesce(CAST(sampleDateTime - INTERVAL 5 HOUR AS DATE), sampleDate)",
        "sampleDateTimeUTC": "sampleDateTime",
        "DEPTH_CODE": "CAST(NULL AS VARCHAR)",
        "LAB": "CAST(NULL AS VARCHAR)",
        "ANALYTE_Orig_Name": "ANALYTE",
        "RESULT": CENSORED_SQL,
        "Units": "Explicit_Units",
        "Orig_QAcode": "QAcode",
        "Orig_QAcomment": "QAcomment",
        "Orig_QAdefinition": "Definition",
    }
    columns = ", ".join(f"{final.get(c, c)} AS {c}" for c in FINAL)
    return f""", limits AS ({lookup_sql(LIMITS)}),
rows AS (SELECT u.*, l.MDL, l.RL FROM unified u LEFT JOIN limits l ON u.ANALYTE IS NOT DISTINCT FROM l.ANALYTE),
lab AS (SELECT {_STANDARD}, {_STATION} AS stationDepth, QAcode, QAcomment FROM rows WHERE {_LAB}),
cast0 AS (SELECT {_STANDARD} FROM rows WHERE NOT {_LAB}),
tuples AS (SELECT DISTINCT SITE_ID, YEAR, sampleDate, stationDepth FROM lab WHERE stationDepth IS NOT NULL),
by_site AS (SELECT SITE_ID, avg(stationDepth) AS d FROM (SELECT DISTINCT SITE_ID, sampleDate, stationDepth FROM tuples) GROUP BY ALL),
by_year AS (SELECT SITE_ID, YEAR, avg(stationDepth) AS d FROM tuples GROUP BY ALL),
deep AS (SELECT SITE_ID, max(sampleDepth) AS d FROM cast0 GROUP BY ALL),
placed AS (SELECT c.*, coalesce(y.d, s.d) AS known, deep.d AS deepest FROM cast0 c
  LEFT JOIN by_site s ON c.SITE_ID = s.SITE_ID LEFT JOIN by_year y ON c.SITE_ID = y.SITE_ID AND c.YEAR = y.YEAR
  LEFT JOIN deep ON c.SITE_ID = deep.SITE_ID),
casts AS (SELECT * EXCLUDE (known, deepest), coalesce(known, deepest) AS stationDepth,
  CASE WHEN known IS NULL AND deepest IS NOT NULL THEN 'D' END AS QAcode,
  CASE WHEN known IS NULL AND deepest IS NOT NULL THEN 'station Depth estimated as the maximum CTD Depth' END AS QAcomment FROM placed),
everything AS (SELECT * FROM lab UNION ALL BY NAME SELECT * FROM casts){_limit_sql('everything', 'limited')},
texts0 AS (SELECT * EXCLUDE (YEAR, QAcode, QAcomment), nullif(QAcode, 'NA') AS QAcode, nullif(QAcomment, 'NA') AS QAcomment FROM limited)
{flag_join_sql('texts0', 'done')}
SELECT {columns} FROM done"""


@query(with_obs(NAMED + assemble_sql()))
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab, casts, again = _sources(spark, sf_dir)
    final = ordered(finish(combine(lab, casts, [again]), lookup(spark, FLAGS)))
    return final.withColumn("stationDepth", steady("stationDepth"))


@query(
    with_obs(
        NAMED
        + assemble_sql()
        .rsplit("SELECT ", 1)[0]
        + f""", final AS (SELECT Study, CodeName, {CENSORED_SQL} AS r, Unified_Flag FROM done)
SELECT Study, CodeName, count(*) AS n, count(r) AS known, count(Unified_Flag) AS flagged,
 {steady_sql('avg(r)', 4)} AS mean, min(r) AS low, max(r) AS high FROM final GROUP BY ALL"""
    )
)
def assembled_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab, casts, again = _sources(spark, sf_dir)
    final = finish(combine(lab, casts, [again]), lookup(spark, FLAGS))
    return final.groupBy("Study", "CodeName").agg(
        F.count("*").alias("n"),
        F.count("RESULT").alias("known"),
        F.count("Unified_Flag").alias("flagged"),
        steady(F.avg("RESULT"), 4).alias("mean"),
        F.min("RESULT").alias("low"),
        F.max("RESULT").alias("high"),
    )
