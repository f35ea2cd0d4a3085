"""Plan shapes that matter at scale."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from obsharmony.operators import groups, joins
from obsharmony.plans.catalog import observations
from obsharmony.session import durable

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scan_reads_only_what_is_needed(spark):
    text = plan(entry.queries()["unpivot_measures"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in text
    filtered = spark.read.parquet(f"{SMALL}/orders.parquet").filter("o_orderstatus = 'P'").select("o_custkey")
    assert "EqualTo(o_orderstatus,P)" in plan(filtered)


def test_lookup_joins_are_broadcast_and_rows_stay(spark):
    text = plan(entry.queries()["harmonize_units"](spark, SMALL))
    assert text.count("BroadcastHashJoin LeftOuter") >= 3 and "Exchange hashpartitioning" not in text


def test_group_values_do_not_move_rows(spark):
    obs = observations(spark, SMALL).select("uid", "SITE_ID", "RESULT")
    text = plan(groups.fill_group_mean(obs, ["SITE_ID"], ["RESULT"]))
    assert "BroadcastHashJoin" in text and "Window" not in text and "hashpartitioning" not in text


def test_written_statistics_are_joined_by_their_size(spark):
    """The optimizer broadcasts a written table by its size on disk, and only then."""
    rows = spark.range(1000).withColumn("k", F.col("id") % 50)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    table = durable(rows.groupBy("k").count())
    try:
        assert "BroadcastHashJoin" in plan(joins.null_safe_join(rows, table, ["k"]))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        assert "SortMergeJoin" in plan(joins.null_safe_join(rows, table, ["k"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


@pytest.mark.parametrize("broadcast", [False, True])
def test_hot_key_join_is_split(spark, broadcast):
    """A key with most of the rows: broadcast when the statistics are small, split when not."""
    keep = {
        k: spark.conf.get(k)
        for k in (
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled",
        )
    }
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB" if broadcast else "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = spark.range(0, 200_000, 1, 8).select(
            "id", F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 1000).alias("g")
        )
        stats = rows.groupBy("g").agg(F.count("*").alias("n"))
        out = joins.null_safe_join(rows, durable(stats), ["g"])
        assert out.agg(F.sum((F.col("g") == 0).cast("long"))).first()[0] >= 160_000
        out.write.format("noop").mode("overwrite").save()
        collected = out.agg(F.max("n"), F.count("*"))
        collected.collect()
        text = plan(collected)
        if broadcast:
            assert "BroadcastHashJoin" in text
        else:
            assert "skew=true" in text or "skewed" in text
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
