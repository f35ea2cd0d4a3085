"""Queries: reshaping, joins by rule, unions, aggregates and window-like fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import matches, paste
from ..functions.text import extract_group, split_once
from ..operators import groups, ordered, reshape
from ..operators.checks import group_condition as group_condition_op
from ..operators.impute import exact_pivot
from ..operators.joins import membership_counts, natural_left_join, null_safe_join
from .catalog import observations, query, steady, steady_sql, table, with_obs
from .harmonisation import collapse_sql

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    """SELECT l_orderkey, l_linenumber, ANALYTE, RESULT
FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem)
UNPIVOT (RESULT FOR ANALYTE IN (l_quantity, l_extendedprice, l_discount, l_tax))"""
)
def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_discount", F.nullif(F.col("l_discount"), F.lit(0.0))
    )
    return reshape.unpivot_long(lines, ["l_orderkey", "l_linenumber"], _MEASURES)


# Wide rows with three numbered groups, one of them often empty.
_WIDE = """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS ANALYTE_1, l_linestatus AS ANALYTE_2,
  CASE WHEN l_tax > 4e-2 THEN 'tax' END AS ANALYTE_3, CAST(l_quantity AS STRING) AS VALUE_1,
  CAST(l_discount AS STRING) AS VALUE_2, CAST(l_tax AS STRING) AS VALUE_3, 'u' || l_linenumber AS UNITS_1,
  'v' AS UNITS_3 FROM {lineitem}"""


@query(
    f"""WITH w AS ({_WIDE.format(lineitem='lineitem').replace('STRING', 'VARCHAR')})
SELECT l_orderkey, l_linenumber, l_partkey, 1 AS Number, ANALYTE_1 AS ANALYTE, VALUE_1 AS VALUE, UNITS_1 AS UNITS FROM w WHERE ANALYTE_1 IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, ANALYTE_2, VALUE_2, NULL FROM w WHERE ANALYTE_2 IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 3, ANALYTE_3, VALUE_3, UNITS_3 FROM w WHERE ANALYTE_3 IS NOT NULL"""
)
def unpivot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = spark.sql(_WIDE, lineitem=table(spark, sf_dir, "lineitem"))
    return reshape.unpivot_groups(wide, required="ANALYTE")


_NAMES = ["click_M0", "click_M1", "click_NA", "view_M0", "view_M1", "view_NA", "signup_M0"]


@query(
    with_obs(
        "SELECT SITE_ID, sampleDepth, "
        + ", ".join(
            steady_sql(
                f"avg(CASE WHEN ANALYTE || '_' || coalesce(METHOD, 'NA') = '{n}' THEN RESULT END)"
            )
            + f" AS {n}"
            for n in _NAMES
        )
        + " FROM obs GROUP BY ALL"
    )
)
def pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = reshape.pivot_wide(
        observations(spark, sf_dir), ["SITE_ID", "sampleDepth"], _NAMES, ["ANALYTE", "METHOD"]
    )
    return wide.select("SITE_ID", "sampleDepth", *[steady(n).alias(n) for n in _NAMES])


@query(
    with_obs(
        """, l AS (SELECT Latitude, Longitude, date_trunc('day', sampleDateTimeUTC) AS sampleDateTimeUTC,
   CASE WHEN uid % 10 > 0 THEN floor(sampleDepth / 10) END AS sampleDepth, 50e0 AS stationDepth, SITE_ID,
   ANALYTE || '_' || UNITS AS name, RESULT FROM obs)
SELECT Latitude, Longitude, sampleDateTimeUTC, sampleDepth, stationDepth, SITE_ID, """
        + ", ".join(
            steady_sql(f"avg(CASE WHEN name = '{n}' THEN RESULT END)") + f' AS "{a}"'
            for n, a in (("click_mg/L", "click"), ("view_ug/L", "view"), ("error_NTU", "error"))
        )
        + " FROM l WHERE sampleDepth IS NOT NULL GROUP BY ALL"
    ),
    name="exact_pivot",
)
def exact_pivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumns(
        {
            "CodeName": F.col("ANALYTE"),
            "Units": F.col("UNITS"),
            "sampleDateTimeUTC": F.date_trunc("day", "sampleDateTimeUTC").cast("timestamp_ntz"),
            "sampleDepth": F.when(F.col("uid") % 10 > 0, F.floor(F.col("sampleDepth") / 10)).cast(
                "double"
            ),
            "stationDepth": F.lit(50.0),
        }
    )
    names = {"click_mg/L": "click", "view_ug/L": "view", "error_NTU": "error"}
    wide = exact_pivot(obs, list(names))
    ids = [c for c in wide.columns if c not in names]
    return wide.select(*ids, *[steady(F.col(f"`{n}`")).alias(a) for n, a in names.items()])


@query(
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS ANALYTE,
  CASE WHEN contains(p_name, ' ') THEN substr(p_name, strpos(p_name, ' ') + 1) END AS UNITS,
  CASE WHEN regexp_matches(p_brand, '^Brand#\\d+$') THEN regexp_extract(p_brand, '^(Brand)#(\\d+)$', 2) END AS number
FROM part"""
)
def split_name_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, unit = split_once("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        name.alias("ANALYTE"),
        unit.alias("UNITS"),
        extract_group("p_brand", r"^(Brand)#(\d+)$", 2).alias("number"),
    )


@query(
    with_obs(
        """SELECT uid, trim(code) AS QAcode FROM (SELECT uid, unnest(string_split(QAcode, ',')) AS code FROM obs)
UNION ALL SELECT uid, NULL FROM obs WHERE QAcode IS NULL"""
    )
)
def split_flags_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reshape.split_to_rows(observations(spark, sf_dir).select("uid", "QAcode"), "QAcode", ",")
    return rows.select("uid", F.trim("QAcode").alias("QAcode"))


@query(
    """WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, nullif(o_totalprice, 0) AS o_totalprice,
  CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders)
SELECT o_orderkey, o_orderstatus AS FRACTION, 'o_totalprice' AS ANALYTE, CAST(floor(o_totalprice) AS BIGINT) AS RESULT FROM s
UNION ALL SELECT o_orderkey, o_orderstatus, 'o_custkey', o_custkey FROM s
UNION ALL SELECT o_orderkey, o_orderpriority, 'o_orderkey2', o_orderkey FROM s"""
)
def blocks_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "orders").withColumn("o_orderkey2", F.col("o_orderkey"))
    long = reshape.blocks_to_long(
        sheet,
        ["o_orderkey"],
        {"o_orderstatus": ["o_totalprice", "o_custkey"], "o_orderpriority": ["o_orderkey2"]},
        "FRACTION",
    )
    whole = F.floor(F.col("RESULT").cast("double")).cast("bigint")
    return long.withColumn("RESULT", whole)


@query(
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS supplier_nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS key", "s_acctbal AS balance", "s_name AS name", "s_nationkey AS supplier_nation"
    )
    return reshape.union_by_name(customers, suppliers)


@query(
    """SELECT c_nationkey, c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) = 1"""
)
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.first_per_key(
        table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_acctbal", "c_custkey"]
    )


@query(
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders),
b AS (SELECT c_custkey AS k FROM customer)
SELECT (SELECT count(*) FROM a) AS left_keys, (SELECT count(*) FROM b) AS right_keys,
       (SELECT count(*) FROM a JOIN b USING (k)) AS shared_keys"""
)
def semi_anti_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return membership_counts(
        orders.withColumnRenamed("o_custkey", "k"), customers.withColumnRenamed("c_custkey", "k"), "k"
    )


@query(
    """SELECT c_custkey, 'with orders' AS side FROM customer SEMI JOIN orders ON c_custkey = o_custkey
UNION ALL SELECT c_custkey, 'without orders' FROM customer ANTI JOIN orders ON c_custkey = o_custkey"""
)
def filter_by_other_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    match = F.col("c_custkey") == F.col("o_custkey")
    have = customers.join(orders, match, "left_semi").withColumn("side", F.lit("with orders"))
    lack = customers.join(orders, match, "left_anti").withColumn("side", F.lit("without orders"))
    return have.unionByName(lack)


@query(
    """SELECT n.n_nationkey, r.r_name AS region_name, n.n_name, coalesce(a.s_acctbal, 0) AS balance
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT s_nationkey, max(s_acctbal) AS s_acctbal FROM supplier GROUP BY ALL) a ON a.s_nationkey = n.n_nationkey"""
)
def natural_and_collision_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey", "n_regionkey AS region", "n_name AS name", "0e0 AS balance"
    )
    regions = table(spark, sf_dir, "region").selectExpr("r_regionkey AS region", "r_name AS region_name")
    best = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.max("s_acctbal").alias("balance"))
    )
    joined = natural_left_join(nations, regions, ["region"])
    # Both sides carry a balance: the right one wins where it is known.
    right = best.withColumnRenamed("balance", "balance_right")
    out = null_safe_join(joined, right, ["n_nationkey"])
    return out.select(
        "n_nationkey",
        "region_name",
        F.col("name").alias("n_name"),
        F.coalesce("balance_right", "balance").alias("balance"),
    )


@query(
    """WITH a AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL),
b AS (SELECT y, p FROM (SELECT unnest(generate_series(1994, 2002)) AS y) CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders))
SELECT CAST(coalesce(a.y, b.y) AS INTEGER) AS y, coalesce(a.p, b.p) AS p, a.n FROM a FULL JOIN b ON a.y = b.y AND a.p = b.p"""
)
def grid_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p")
    )
    counts = orders.groupBy("y", "p").agg(F.count("*").alias("n"))
    years = F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("y")
    grid = orders.select("p").distinct().select(years, "p")
    return null_safe_join(counts, grid, ["y", "p"], "full")


@query(
    """SELECT c.c_custkey, coalesce(o.n, 0) AS n, o.last_order
FROM (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_order FROM orders GROUP BY ALL) o
RIGHT JOIN customer c ON o.o_custkey = c.c_custkey"""
)
def right_join_keep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_order"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    out = null_safe_join(done, customers, ["c_custkey"], "right")
    return out.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), "last_order")


@query(
    with_obs(
        """SELECT SITE_ID, uid, last_value(RESULT IGNORE NULLS) OVER (PARTITION BY SITE_ID ORDER BY uid
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS RESULT
FROM (SELECT SITE_ID, uid, CASE WHEN uid % 3 = 0 THEN RESULT END AS RESULT FROM obs)"""
    )
)
def carry_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = observations(spark, sf_dir).select(
        "SITE_ID", "uid", F.when(F.col("uid") % 3 == 0, F.col("RESULT")).alias("RESULT")
    )
    return ordered.carry_forward(sparse, ["SITE_ID"], "uid", "RESULT")


@query(
    with_obs(
        f"""SELECT ANALYTE, METHOD, count(*) AS n, count(RESULT) AS known, {steady_sql('avg(RESULT)')} AS mean,
  min(RESULT) AS low, max(RESULT) AS high, {steady_sql('stddev_samp(RESULT)', 4)} AS sd,
  count(DISTINCT SITE_ID) AS sites, {steady_sql("avg(CASE WHEN QAcode = 'E' THEN RESULT END)")} AS mean_e
FROM obs GROUP BY ALL"""
    )
)
def group_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("ANALYTE", "METHOD").agg(
        F.count("*").alias("n"),
        F.count("RESULT").alias("known"),
        steady(F.avg("RESULT")).alias("mean"),
        F.min("RESULT").alias("low"),
        F.max("RESULT").alias("high"),
        steady(F.stddev_samp("RESULT"), 4).alias("sd"),
        F.count_distinct("SITE_ID").alias("sites"),
        steady(F.avg(F.when(F.col("QAcode") == "E", F.col("RESULT")))).alias("mean_e"),
    )


@query(
    with_obs(
        f"""SELECT SITE_ID, {steady_sql('avg(sampleDepth)')} AS meanDepth FROM
  (SELECT DISTINCT SITE_ID, CAST(sampleDateTimeUTC AS DATE) AS d, sampleDepth FROM obs) GROUP BY ALL"""
    )
)
def mean_of_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("d", F.col("sampleDateTimeUTC").cast("date"))
    means = groups.mean_of_distinct(obs, ["SITE_ID"], "sampleDepth", ["d"], "meanDepth")
    return means.select("SITE_ID", steady("meanDepth").alias("meanDepth"))


@query(
    with_obs(
        f""", a AS ({collapse_sql('obs', ['SITE_ID', 'ANALYTE'], 'QAcode', 'uid')}),
b AS ({collapse_sql('obs', ['SITE_ID', 'ANALYTE'], 'METHOD', 'uid')})
SELECT SITE_ID, ANALYTE, QAcode, METHOD FROM a JOIN b USING (SITE_ID, ANALYTE)"""
    )
)
def collapse_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.collapse_texts(
        observations(spark, sf_dir), ["SITE_ID", "ANALYTE"], ["QAcode", "METHOD"], "uid"
    )


@query(
    f"""SELECT l_returnflag, l_linestatus, {steady_sql('quantile_cont(l_extendedprice, 0.025)')} AS p025,
  {steady_sql('quantile_cont(l_extendedprice, 0.5)')} AS p50, {steady_sql('quantile_cont(l_extendedprice, 0.975)')} AS p975,
  min(l_extendedprice) AS low FROM lineitem GROUP BY ALL"""
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = {"low": 0.0, "p025": 0.025, "p50": 0.5, "p975": 0.975}
    by = ["l_returnflag", "l_linestatus"]
    out = ordered.quantiles(table(spark, sf_dir, "lineitem"), by, "l_extendedprice", probs)
    return out.select(*by, "low", *[steady(p).alias(p) for p in ("p025", "p50", "p975")])


@query(
    with_obs(
        f"""SELECT o.uid, m.deepest, {steady_sql('m.median')} AS median, o.sampleDepth = m.deepest AS at_bottom FROM obs o
JOIN (SELECT SITE_ID, max(sampleDepth) AS deepest, quantile_cont(Longitude, 0.5) AS median FROM obs GROUP BY ALL) m
ON o.SITE_ID = m.SITE_ID"""
    )
)
def group_max_median_beside(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).select("uid", "SITE_ID", "sampleDepth", "Longitude")
    deep = groups.with_group_stats(obs, ["SITE_ID"], deepest=F.max("sampleDepth"))
    medians = ordered.quantiles(obs, ["SITE_ID"], "Longitude", {"median": 0.5})
    return null_safe_join(deep, medians, ["SITE_ID"]).select(
        "uid",
        "deepest",
        steady("median").alias("median"),
        (F.col("sampleDepth") == F.col("deepest")).alias("at_bottom"),
    )


@query(
    with_obs(
        """, g AS (SELECT *, count(*) FILTER (WHERE RESULT > 15.5e0) OVER w > 1 AND count(*) FILTER (WHERE RESULT < 5) OVER w > 1 AS thermocline
  FROM obs WINDOW w AS (PARTITION BY SITE_ID, CAST(sampleDateTimeUTC AS DATE)))
SELECT uid, thermocline FROM g"""
    )
)
def group_condition_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("day", F.col("sampleDateTimeUTC").cast("date"))
    marked = group_condition_op(obs, ["SITE_ID", "day"], "RESULT", 15.5, 5.0, "thermocline")
    return marked.select("uid", "thermocline")


@query(
    with_obs(
        """SELECT uid FROM obs WHERE RESULT IS NOT NULL
QUALIFY count(RESULT) OVER (PARTITION BY SITE_ID, ANALYTE, METHOD) > 12"""
    )
)
def filter_by_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = observations(spark, sf_dir).filter(F.col("RESULT").isNotNull())
    counted = groups.with_group_stats(known, ["SITE_ID", "ANALYTE", "METHOD"], seen=F.count("RESULT"))
    return counted.filter(F.col("seen") > 12).select("uid")


@query(
    with_obs(
        """SELECT uid, CAST(sampleDateTimeUTC AS DATE) AS sampleDate, SITE_ID, sampleDepth, METHOD FROM obs
ORDER BY sampleDate NULLS LAST, SITE_ID NULLS LAST, METHOD NULLS LAST, sampleDepth NULLS LAST, uid"""
    )
)
def sorted_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations(spark, sf_dir).select(
        "uid", F.col("sampleDateTimeUTC").cast("date").alias("sampleDate"), "SITE_ID", "sampleDepth", "METHOD"
    )
    keys = ["sampleDate", "SITE_ID", "METHOD", "sampleDepth", "uid"]
    return rows.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


@query(
    with_obs(
        """SELECT ANALYTE, count(*) FILTER (WHERE RESULT IS NULL) AS missing, count(RESULT) AS known FROM obs
WHERE coalesce(QAcomment, '') NOT LIKE '%recheck%' AND (RESULT IS NOT NULL OR QAcode IS NOT NULL)
  AND coalesce(METHOD NOT IN ('M1'), TRUE) GROUP BY ALL ORDER BY missing DESC, known DESC"""
    )
)
def filters_and_report_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.nulls import is_in

    kept = observations(spark, sf_dir).filter(
        ~matches("QAcomment", "RECHECK", ignore_case=True)
        & (F.col("RESULT").isNotNull() | F.col("QAcode").isNotNull())
        & ~is_in("METHOD", ["M1"])
    )
    counts = kept.groupBy("ANALYTE").agg(
        F.count_if(F.col("RESULT").isNull()).alias("missing"), F.count("RESULT").alias("known")
    )
    return counts.orderBy(F.desc("missing"), F.desc("known"))


@query(
    """SELECT o_orderkey, year(o_orderdate) || '-' || month(o_orderdate) || '-' || coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END, 'NA') AS label,
  CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS part FROM orders"""
)
def unite_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        paste(F.year("o_orderdate"), F.month("o_orderdate"), part, sep="-").alias("label"),
        part.alias("part"),
    )


@query(
    """WITH s AS (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'), n AS (SELECT c_nationkey, max(c_acctbal) AS m FROM s GROUP BY ALL)
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT c_nationkey AS c_custkey, 'TOP' AS c_mktsegment, m FROM n"""
)
def replace_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    own = F.col("c_mktsegment") == "BUILDING"
    derived = (
        customers.filter(own)
        .groupBy(F.col("c_nationkey").cast("bigint").alias("c_custkey"))
        .agg(F.max("c_acctbal").alias("c_acctbal"))
        .withColumn("c_mktsegment", F.lit("TOP"))
    )
    rest = customers.filter(~own).select("c_custkey", "c_mktsegment", "c_acctbal")
    return rest.unionByName(derived)
