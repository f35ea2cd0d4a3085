"""Queries: tables written as files of each kind and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from ..sources import cast_files, readers
from .catalog import query, table

_ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*[F.col(c).cast(k).alias(c) for c, k in _ORDERS.items()])


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
)
def csv_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headed CSV tables with manifests, read as one by declared types, for the listed customers."""
    orders, out = _orders(spark, sf_dir), scratch(spark, "orders-csv")
    late = F.col("o_orderdate") >= "1996-01-01"
    parts = [("early", orders.where(~F.coalesce(late, F.lit(False)))), ("late", orders.where(late))]
    paths = [readers.write_checked(rows, f"{out}/{name}", binary=False) for name, rows in parts]
    for path in paths:
        readers.read_checked(spark, path)
    listed = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return readers.keep_samples(readers.read_table(spark, paths, _ORDERS), listed, "o_custkey")


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
WHERE o_totalprice > 100000"""
)
def columnar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet table with its manifest, read back; the filter reaches the scan."""
    path = readers.write_checked(_orders(spark, sf_dir), scratch(spark, "orders"))
    return readers.read_checked(spark, path, _ORDERS).where("o_totalprice > 100000")


@query(
    """SELECT CAST(c_nationkey AS INTEGER) AS nation, row_no, c_custkey, c_acctbal, c_name FROM (
  SELECT c_nationkey, c_custkey, c_acctbal, c_name || ', "' || c_mktsegment || '"' AS c_name,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_no FROM customer) WHERE row_no >= 9"""
)
def sheet_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV sheet per nation, read from its ninth row on, in the order of the file."""
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal", name.alias("c_name"))
    out = scratch(spark, "sheets")
    placed = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    placed.write.partitionBy("c_nationkey").option("header", True).option("escape", '"').csv(out)
    sheets = readers.read_sheet_rows(spark, out, {"c_name": "string", "c_custkey": "bigint", "c_acctbal": "double"}, first=9)
    nation = F.regexp_extract("sheet", "c_nationkey=([0-9]+)", 1).cast("int")
    return sheets.select(nation.alias("nation"), "row_no", "c_custkey", "c_acctbal", "c_name")


# One cast file per user: some lack the end of their header, some a depth column.
_CAST_LINES = """SELECT user_id, 100 + event_id AS line_no, '  ' || event_id % 41 || ' 12.5' AS line FROM {events}
UNION ALL SELECT user_id, n, CASE n WHEN 1 THEN '* Latitude = 43.5' WHEN 2 THEN CASE WHEN user_id % 10 = 4 THEN '# name 0 = sal00: Salinity' ELSE '# name 0 = depSM: Depth' END
  WHEN 3 THEN CASE WHEN user_id % 3 = 0 THEN '# name 1 = t090C: Temperature' ELSE '# name 1 = par: Light' END
  WHEN 4 THEN CASE WHEN user_id % 10 = 3 THEN '# no end' ELSE '*END*' END END
FROM (SELECT user_id, explode(sequence(1, 4)) AS n FROM (SELECT DISTINCT user_id FROM {events}))"""


def _written_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast lines as text files below folders, listed and read again."""
    lines = spark.sql(_CAST_LINES, events=table(spark, sf_dir, "events"))
    out = scratch(spark, "casts")
    placed = lines.repartition("user_id").sortWithinPartitions("user_id", "line_no")
    placed.select("user_id", F.col("line").alias("value")).write.partitionBy("user_id").text(out)
    read = readers.read_lines(spark, out, "*.txt")
    return read.withColumn("path", F.regexp_extract("path", "user_id=([^/]+)", 1))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS path, CASE WHEN user_id % 10 = 3 THEN 'no end of header' ELSE 'no depth column' END AS reason
FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 10 IN (3, 4)"""
)
def cast_file_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _written_casts(spark, sf_dir)
    return cast_files.file_errors(lines, cast_files.headers(lines))


@query(
    """SELECT name, count(DISTINCT user_id) AS files FROM (
  SELECT user_id, unnest([CASE WHEN user_id % 10 = 4 THEN 'sal00' ELSE 'depsm' END, CASE WHEN user_id % 3 = 0 THEN 't090c' ELSE 'par' END]) AS name FROM events)
GROUP BY name"""
)
def cast_name_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_files.name_census(cast_files.headers(_written_casts(spark, sf_dir)))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS path, CASE WHEN n > 4 THEN CAST(event_id % 41 AS BIGINT) END AS first_cell, n AS line_no FROM (
  SELECT user_id, event_id, 4 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events
  UNION ALL SELECT user_id, NULL, unnest([1, 2, 3, 4]) FROM (SELECT DISTINCT user_id FROM events))"""
)
def cast_lines_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _written_casts(spark, sf_dir)
    cell = F.get(F.split(F.trim("line"), r"\s+"), F.lit(0)).try_cast("bigint")
    return lines.select("path", cell.alias("first_cell"), "line_no")
