"""Queries: depth profiles, imputation, matching and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, impute, match, profiles
from .catalog import observations, query, steady, steady_sql, table, with_obs
from .harmonisation import (
    CENSORED_SQL,
    NAMED,
    collapse_sql,
    flag_join_sql,
    in_common_units,
)
from .lookups import FLAGS, NAME_MAP, lookup, lookup_sql

# A cast per user and day: the event id is the scan, the depth goes down and up.
_CAST = """SELECT user_id AS cast_id, CAST(ts AS DATE) AS day, event_id AS scan,
  CAST((event_id * 7) % 41 AS DOUBLE) / 2 AS depth, value AS temperature, value / 3 AS oxygen FROM {events}"""


def _casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_CAST, events=table(spark, sf_dir, "events"))


def _with_casts(sql: str) -> str:
    return f"WITH casts AS ({_CAST.format(events='events')}){sql}"


@query(
    _with_casts(
        f""" SELECT cast_id, CAST(floor(depth - 5e-1) + 1 AS DOUBLE) AS depth, {steady_sql('avg(temperature)')} AS temperature,
 {steady_sql('avg(oxygen)')} AS oxygen FROM casts WHERE depth >= 5e-1 GROUP BY cast_id, floor(depth - 5e-1)"""
    )
)
def depth_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = profiles.metre_bins(_casts(spark, sf_dir), ["cast_id"], "depth", ["temperature", "oxygen"])
    return bins.select(
        "cast_id", "depth", steady("temperature").alias("temperature"), steady("oxygen").alias("oxygen")
    )


@query(
    _with_casts(
        f""" SELECT cast_id, round_even(depth, 0) AS depth, {steady_sql('avg(temperature)')} AS temperature, min(scan) AS scan
FROM casts WHERE round_even(depth, 0) <> 0 GROUP BY cast_id, round_even(depth, 0)"""
    )
)
def round_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = profiles.whole_metre_bins(_casts(spark, sf_dir), ["cast_id"], "depth", "temperature", "scan")
    return bins.select("cast_id", "depth", steady("temperature").alias("temperature"), "scan")


@query(
    _with_casts(
        """, turn AS (SELECT cast_id, day, scan AS turn FROM casts
  QUALIFY row_number() OVER (PARTITION BY cast_id, day ORDER BY depth DESC, scan) = 1)
SELECT c.* FROM casts c JOIN turn t ON c.cast_id = t.cast_id AND c.day = t.day WHERE c.scan <= t.turn AND c.depth > 1e-1"""
    )
)
def downcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = profiles.downcast(_casts(spark, sf_dir), ["cast_id", "day"], "scan", "depth")
    return profiles.usable_scans(trimmed, "depth")


@query(
    _with_casts(
        """, r AS (SELECT *, median(temperature) OVER (PARTITION BY cast_id ORDER BY scan ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS ref FROM casts),
s AS (SELECT cast_id, stddev_samp(temperature - ref) AS sd FROM r GROUP BY ALL)
SELECT r.cast_id, r.scan, CASE WHEN abs(r.temperature - r.ref) > 2e0 * s.sd THEN r.ref ELSE r.temperature END AS temperature
FROM r JOIN s ON r.cast_id = s.cast_id"""
    )
)
def despike(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = profiles.despike(
        _casts(spark, sf_dir), ["cast_id"], "scan", ["temperature"], half_width=3, spread=2.0
    )
    return clean.select("cast_id", "scan", "temperature")


_DEPTH_CODES = """SELECT uid, sampleDepth, CASE uid % 12 WHEN 0 THEN 'Surface' WHEN 1 THEN 'Mid Epilimnion' WHEN 2 THEN 'Thermocline'
  WHEN 3 THEN 'Upper Hypolimnion' WHEN 4 THEN 'Five meters' WHEN 5 THEN 'Bottom less 1' WHEN 6 THEN 'One hundred'
  WHEN 7 THEN '.' WHEN 8 THEN 'Not Applicable' WHEN 9 THEN 'Lower Epilimnion' WHEN 10 THEN 'Deep Chlorophyll Layer' END AS DEPTH_CODE
FROM {obs}"""


@query(
    with_obs(
        f""", c AS ({_DEPTH_CODES.format(obs='obs')}),
k AS (SELECT DEPTH_CODE, sampleDepth, CASE WHEN DEPTH_CODE IN ('Surface', 'Mid Epilimnion', 'Lower Epilimnion') THEN 'Epilimnion'
   WHEN DEPTH_CODE IN ('Mid Hypolimnion', 'Upper Hypolimnion') THEN 'Hypolimnion' ELSE DEPTH_CODE END AS layer FROM c
  WHERE DEPTH_CODE IN ('Surface', 'Mid Epilimnion', 'Thermocline', 'Upper Hypolimnion', 'Lower Epilimnion', 'Deep Chlorophyll Layer'))
SELECT layer, {', '.join(steady_sql(f'quantile_cont(sampleDepth, {p})') + ' AS ' + n for n, p in
  (('minimum', '0'), ('p025', '0.025'), ('p50', '0.5'), ('p975', '0.975'), ('maximum', '1')))} FROM k GROUP BY ALL"""
    )
)
def depth_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = spark.sql(_DEPTH_CODES, obs=observations(spark, sf_dir))
    layers = profiles.named_layers(codes, "DEPTH_CODE")
    bands = profiles.depth_bands(layers, "layer", "sampleDepth")
    return bands.select("layer", *[steady(c).alias(c) for c in bands.columns if c != "layer"])


@query(
    """SELECT c_custkey, coalesce(lat_ctd, lat) AS lat, coalesce(t_ctd, t) AS t FROM (SELECT c_custkey, c_acctbal AS lat,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 END AS lat_ctd, c_name AS t, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS t_ctd FROM customer)"""
)
def prefer_instrument(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_acctbal AS lat",
        "CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 END AS lat_ctd",
        "c_name AS t",
        "CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS t_ctd",
    )
    return profiles.prefer_instrument(rows)


# --- imputation -------------------------------------------------------------------

_LONG = """SELECT uid, Study, date_trunc('day', sampleDateTimeUTC) AS sampleDateTimeUTC, Latitude, Longitude,
  sampleDepth, ANALYTE AS CodeName, RESULT, CASE WHEN ANALYTE IN ('click', 'view') AND uid % 2 = 0 THEN 5e0 + uid % 3 END AS MDL,
  CASE WHEN ANALYTE IN ('click', 'error') THEN 2e1 + uid % 5 END AS RL,
  CASE WHEN QAcode = 'ND' THEN 'N' WHEN QAcode = 'E' THEN 'E' END AS Unified_Flag, QAcomment AS Unified_Comment FROM {obs}"""


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_LONG, obs=observations(spark, sf_dir))
    return rows.withColumn("sampleDateTimeUTC", F.col("sampleDateTimeUTC").cast("timestamp_ntz"))


_POS = ["Latitude", "Longitude", "sampleDateTimeUTC", "CodeName", "sampleDepth"]


def _limit_fill_sql(f: str) -> str:
    texts = ["Study", "Unified_Flag", "Unified_Comment"]
    same = " AND ".join(f"p.{c} = x.{c}" for c in _POS)
    joins = " ".join(
        f"JOIN ({collapse_sql('l', _POS, c, 'uid')}) {c} ON {same.replace('x.', c + '.')}" for c in texts
    )
    keys = ", ".join(f"p.{c}" for c in _POS)
    return f""", l AS ({_LONG.format(obs='obs')}),
p AS (SELECT {', '.join(_POS)}, avg(RESULT) AS RESULT, avg(MDL) AS MDL, avg(RL) AS RL FROM l GROUP BY ALL),
d AS (SELECT {keys}, p.RESULT, p.MDL, p.RL, Study.Study, Unified_Flag.Unified_Flag, Unified_Comment.Unified_Comment,
      CAST(year(p.sampleDateTimeUTC) AS INTEGER) AS "Year" FROM p {joins}),
g AS (SELECT Study, "Year", CodeName, avg(MDL) AS m, avg(RL) AS r, count(RESULT) AS seen, min(RESULT) AS low FROM d GROUP BY ALL),
o AS (SELECT d.* EXCLUDE (RESULT, MDL, RL), g.m AS MDL, g.r AS RL, CASE WHEN RESULT IS NOT NULL THEN RESULT
   WHEN contains(regexp_replace(Unified_Flag, '\\bNA\\b', '', 'g'), 'N') AND (g.m IS NOT NULL OR g.seen > 1) THEN {f.format(x='least(g.m, g.r, g.low)')}
   WHEN g.m IS NOT NULL THEN {f.format(x='g.m')} WHEN g.r IS NOT NULL THEN {f.format(x='g.r')} END AS RESULT
  FROM d JOIN g ON d.Study = g.Study AND d."Year" = g."Year" AND d.CodeName = g.CodeName)
SELECT * REPLACE ({steady_sql('RESULT')} AS RESULT, {steady_sql('MDL')} AS MDL, {steady_sql('RL')} AS RL) FROM o"""


def _limit_fill(spark: SparkSession, sf_dir: str, method: str | None) -> DataFrame:
    filled = impute.detection_limit_fill(_long(spark, sf_dir), "uid", method, seed=11)
    return filled.withColumns({c: steady(c) for c in ("RESULT", "MDL", "RL")})


@query(with_obs(_limit_fill_sql("({x}) / 2")))
def mdl_impute_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limit_fill(spark, sf_dir, "halfMDL")


@query(with_obs(_limit_fill_sql("{x}")))
def mdl_impute_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limit_fill(spark, sf_dir, None)


_DRAW = """(({x}) * ((CAST('0x' || substr(md5(concat_ws('|', '11', CAST(round(d.Latitude * 1e6) AS BIGINT), CAST(round(d.Longitude * 1e6) AS BIGINT),
  epoch_us(d.sampleDateTimeUTC), d.CodeName, CAST(round(d.sampleDepth * 1e6) AS BIGINT), d.Study)), 1, 13) AS BIGINT) + 5e-1) / 4503599627370496e0))"""


@query(with_obs(_limit_fill_sql(_DRAW)))
def mdl_impute_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limit_fill(spark, sf_dir, "uniform")


@query(
    with_obs(
        f""", l AS ({_LONG.format(obs='obs')}), m AS (SELECT CodeName, avg(MDL) AS d FROM l GROUP BY ALL)
SELECT l.uid, {steady_sql('coalesce(l.RESULT, m.d)')} AS RESULT FROM l JOIN m ON l.CodeName = m.CodeName"""
    )
)
def mean_mdl_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute.mean_limit_fill(_long(spark, sf_dir))
    return filled.select("uid", steady("RESULT").alias("RESULT"))


_WIDE = """SELECT uid, SITE_ID, sampleDateTimeUTC, Latitude, Longitude, sampleDepth, RESULT AS Temp_c,
  CASE WHEN uid % 3 = 0 THEN RESULT / 2 END AS DO_mgl, CASE WHEN uid % 8 > 0 THEN 1e0 + uid % 9 END AS Chla_ugl FROM {obs}"""
_DEGREES, _DAYS = 0.06, 6.0


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_WIDE, obs=observations(spark, sf_dir))


def _g(x: str) -> str:
    total = "1e0"
    for i in range(9, 0, -1):
        total = f"(1e0 + ({x} / 15e-1) * {total} / {i}e0)"
    return f"(CASE WHEN {x} <= 0 THEN 0e0 ELSE 1e0 - exp(-({x} / 15e-1)) * {total} END)"


_NEAREST = f""", w AS ({_WIDE.format(obs='obs')}),
x AS (SELECT *, {_g('sampleDepth')} AS g, epoch_us(sampleDateTimeUTC) AS us,
      CASE WHEN sampleDepth > 30 THEN 15e0 ELSE 5e0 END AS win FROM w),
pairs AS (SELECT q.uid, c.Temp_c AS hit, row_number() OVER (PARTITION BY q.uid ORDER BY
   (1e0 / 6e-2) * sqrt((q.Latitude - c.Latitude) * (q.Latitude - c.Latitude) + (q.Longitude - c.Longitude) * (q.Longitude - c.Longitude))
   + (1e0 / q.win) * abs(q.g - c.g) + (1e0 / 6e0) * (abs(q.us - c.us) / 864e8), c.uid) AS rn
  FROM x q JOIN x c ON c.us BETWEEN q.us - 518400000000 AND q.us + 518400000000
   AND c.Latitude BETWEEN q.Latitude - 6e-2 AND q.Latitude + 6e-2
   AND c.sampleDepth BETWEEN q.sampleDepth - q.win AND q.sampleDepth + q.win
  WHERE q.Temp_c IS NULL AND q.Chla_ugl IS NOT NULL AND c.Temp_c IS NOT NULL),
filled AS (SELECT w.* EXCLUDE (Temp_c), coalesce(w.Temp_c, p.hit) AS Temp_c FROM w LEFT JOIN pairs p ON w.uid = p.uid AND p.rn = 1)
"""


def nearest_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = match.Limits(days=_DAYS, degrees=_DEGREES)
    return match.fill_nearest(_wide(spark, sf_dir), "Temp_c", "Chla_ugl", "uid", limits)


@query(with_obs(_NEAREST + "SELECT uid, Temp_c FROM filled"))
def nearest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_filled(spark, sf_dir).select("uid", "Temp_c")


def _share(source: str, step: str) -> str:
    cols = ", ".join(
        steady_sql(f"avg(CASE WHEN {c} IS NULL AND Chla_ugl IS NOT NULL THEN 1e0 ELSE 0e0 END)") + f" AS {c}"
        for c in ("Temp_c", "DO_mgl")
    )
    return f"SELECT '{step}' AS step, {cols} FROM {source}"


@query(with_obs(_NEAREST + _share("w", "before") + " UNION ALL " + _share("filled", "after")))
def fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = impute.fill_report(
        _wide(spark, sf_dir), nearest_filled(spark, sf_dir), ["Temp_c", "DO_mgl"], "Chla_ugl"
    )
    return report.select("step", steady("Temp_c").alias("Temp_c"), steady("DO_mgl").alias("DO_mgl"))


_FOREST = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_partkey") % 5 > 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_suppkey") % 7 > 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
    )


@query()
def forest_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.forest_fill(_with_gaps(spark, sf_dir), _FOREST)


@query()
def forest_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _with_gaps(spark, sf_dir)
    filled = impute.forest_fill(lines, _FOREST)
    return impute.forest_error(lines, filled, _FOREST, ["l_orderkey", "l_linenumber"])


@query(
    with_obs("SELECT ANALYTE, count(RESULT) AS measureCount, count(*) - count(RESULT) AS missingCount FROM obs GROUP BY ALL")
)
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.missing_counts(observations(spark, sf_dir), ["ANALYTE"])


# --- quality reports ----------------------------------------------------------------

_PROFILE = ["RESULT", "METHOD", "QAcode", "QAcomment", "Latitude"]


@query(
    with_obs(
        "SELECT Study, "
        + ", ".join(steady_sql(f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)") + f" AS {c}" for c in _PROFILE)
        + " FROM obs GROUP BY ROLLUP (Study)"
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    overall = checks.null_share(obs, _PROFILE).withColumn("Study", F.lit(None).cast("string"))
    shares = overall.unionByName(checks.null_share(obs, _PROFILE, ["Study"]))
    return shares.select("Study", *[steady(c).alias(c) for c in _PROFILE])


@query(with_obs("SELECT Study, " + ", ".join(f"count({c}) AS {c}" for c in _PROFILE) + " FROM obs GROUP BY ALL"))
def known_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.known_counts(observations(spark, sf_dir), _PROFILE, ["Study"])


_REPORT = ", rep AS (SELECT *, ANALYTE AS CodeName, QAcode AS Unified_Flag, CAST(year(sampleDateTimeUTC) AS INTEGER) AS Years FROM obs)"


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).withColumns(
        {"CodeName": F.col("ANALYTE"), "Unified_Flag": F.col("QAcode")}
    )


def _with_texts(source: str, by: list[str], texts: dict[str, str]) -> str:
    """Row counts per group with collapsed texts beside them."""
    keys = ", ".join(by)
    joins = " ".join(
        f"JOIN (SELECT {keys}, {c} AS t_{a} FROM ({collapse_sql(source, by, c, 'uid')})) USING ({keys})"
        for c, a in texts.items()
    )
    cols = ", ".join(f"t_{a} AS {a}" for a in texts.values())
    return f'SELECT {keys}, n AS "count", {cols} FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY ALL) {joins}'


@query(
    with_obs(
        _REPORT
        + ", odd AS (SELECT * FROM rep WHERE RESULT IS NULL AND NOT coalesce(regexp_matches(Unified_Flag, '(?i)B|N|R'), FALSE)) "
        + _with_texts("odd", ["Study", "CodeName"], {"Years": "Years", "Unified_Flag": "Uflags", "QAcode": "QAcodes"})
    )
)
def unexplained_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unexplained_nulls(_report(spark, sf_dir), "uid")


@query(
    with_obs(
        _REPORT
        + ", low AS (SELECT *, CASE WHEN RESULT < 0 THEN 'Negative' ELSE 'Zero' END AS type FROM rep WHERE RESULT <= 0) "
        + _with_texts("low", ["Study", "CodeName", "type"], {"Years": "Years", "Unified_Flag": "flags"})
    )
)
def zero_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.zero_census(_report(spark, sf_dir), "uid")


_POSITIONS = """, pos AS (SELECT round_even(Latitude, 1) AS Lat, round_even(Longitude, 1) AS Lon,
  date_trunc('day', sampleDateTimeUTC) AS sampleDateTimeUTC, ANALYTE AS CodeName, floor(sampleDepth / 20) AS sampleDepth, Study, uid FROM obs),
rep AS (SELECT *, count(*) OVER (PARTITION BY Lat, Lon, sampleDateTimeUTC, CodeName, sampleDepth) AS n FROM pos),
many AS (SELECT * FROM rep WHERE n > 1)
"""


@query(
    with_obs(
        _POSITIONS
        + _with_texts("many", ["Lat", "Lon", "sampleDateTimeUTC", "CodeName", "sampleDepth"], {"Study": "Study"})
    )
)
def dup_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "sampleDateTimeUTC").cast("timestamp_ntz")
    layer = F.floor(F.col("sampleDepth") / 20).cast("double")
    rows = _report(spark, sf_dir).withColumns({"sampleDateTimeUTC": day, "sampleDepth": layer})
    return checks.duplicate_census(rows, digits=1, order="uid")


@query(
    with_obs(
        """, s AS (SELECT DISTINCT digits, Study || '-' || SITE_ID AS SITE, CASE WHEN length(Study) > 7 THEN substr(Study, 1, 4) || '...' ELSE Study END AS Study,
  round_even(Latitude, digits) AS Lat, round_even(Longitude, digits) AS Lon FROM obs, (SELECT unnest([2, 3, 4, 5]) AS digits))
SELECT digits, Lat, Lon, count(DISTINCT Study) > 1 AS multipleStudies, count(*) AS "count", string_agg(DISTINCT SITE, ', ' ORDER BY SITE) AS studies FROM s GROUP BY ALL"""
    )
)
def site_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.site_overlap(observations(spark, sf_dir), (2, 3, 4, 5))


@query(
    with_obs(
        "SELECT Study, ANALYTE, "
        + ", ".join(
            steady_sql(f"{f}({c})", 4) + f" AS {c}_{n}"
            for c in ("Latitude", "RESULT")
            for n, f in (("mean", "avg"), ("sd", "stddev_samp"))
        )
        + " FROM obs GROUP BY ALL"
    )
)
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, by = ["Latitude", "RESULT"], ["Study", "ANALYTE"]
    stats = checks.summary_stats(observations(spark, sf_dir), columns, by)
    return stats.select(*by, *[steady(c, 4).alias(c) for c in stats.columns if c not in by])


@query(
    with_obs(
        NAMED
        + """SELECT Study, count(*) FILTER (WHERE CodeName IS NULL) AS unmapped, count(*) FILTER (WHERE TargetUnits IS NULL) AS noTargetUnit,
 count(*) FILTER (WHERE ReportedUnits <> TargetUnits AND ConversionFactor IS NULL) AS noFactor FROM unified GROUP BY ALL"""
    )
)
def map_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mapping_gaps(in_common_units(spark, observations(spark, sf_dir)))


@query(
    with_obs(
        f""" SELECT DISTINCT o.ANALYTE, o.METHOD FROM obs o WHERE NOT EXISTS (SELECT 1 FROM ({lookup_sql(NAME_MAP)}) n
WHERE n.ANALYTE IS NOT DISTINCT FROM o.ANALYTE AND n.METHOD IS NOT DISTINCT FROM o.METHOD)"""
    )
)
def unmapped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unmapped_names(
        observations(spark, sf_dir), lookup(spark, NAME_MAP), ["ANALYTE", "METHOD"]
    )


@query(
    with_obs(
        f"""SELECT sampleDepth, count(*) AS readings, count(*) FILTER (WHERE RESULT > 100) AS over,
 {steady_sql('avg(CASE WHEN RESULT > 100 THEN 1e0 WHEN RESULT IS NOT NULL THEN 0e0 END)')} AS share
FROM obs WHERE ANALYTE = 'purchase' GROUP BY ALL"""
    )
)
def light_over_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("ANALYTE") == "purchase", F.lit("CPAR")).otherwise(F.col("ANALYTE"))
    report = checks.light_over_100(
        observations(spark, sf_dir).withColumn("CodeName", code), ["sampleDepth"]
    )
    return report.withColumn("share", steady("share"))


@query(
    with_obs(
        """, s AS (SELECT Latitude, Longitude, count(*) FILTER (Study = 'survey_0') > 1 AS first, count(*) FILTER (Study = 'survey_1') > 1 AS second
  FROM obs GROUP BY ALL) SELECT first, second, count(*) AS sites FROM s GROUP BY ALL"""
    )
)
def site_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"first": "survey_0", "second": "survey_1"}
    return checks.coverage(observations(spark, sf_dir), ["Latitude", "Longitude"], "Study", kinds)
