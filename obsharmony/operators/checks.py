"""Data-quality reports and run-time assertions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import matches
from ..functions.numeric import round_half_even
from ..functions.text import truncate_right
from .groups import collapse_texts
from .joins import null_safe_join


def require(df: DataFrame, broken: Column, message: str) -> None:
    """Stop with the number of rows that break a rule; one bounded aggregate."""
    n = df.filter(F.coalesce(broken, F.lit(True))).count()
    if n:
        raise ValueError(f"{message} ({n} rows)")


def null_share(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of NULLs per column, overall or per group."""
    return df.groupBy(*by).agg(
        *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]
    )


def known_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Non-NULL values per column and group."""
    return df.groupBy(*by).agg(*[F.count(c).alias(c) for c in columns])


def unexplained_nulls(df: DataFrame, order: str) -> DataFrame:
    """Missing results without a flag that explains them, with their years and texts."""
    odd = df.filter(
        F.col("RESULT").isNull() & ~matches("Unified_Flag", "B|N|R", ignore_case=True)
    ).withColumn("Years", F.year("sampleDateTimeUTC"))
    by = ["Study", "CodeName"]
    texts = collapse_texts(odd, by, ["Years", "Unified_Flag", "QAcode"], order)
    counts = odd.groupBy(*by).agg(F.count("*").alias("count"))
    return null_safe_join(
        counts, texts.withColumnsRenamed({"Unified_Flag": "Uflags", "QAcode": "QAcodes"}), by, "inner"
    )


def zero_census(df: DataFrame, order: str) -> DataFrame:
    """Zero and negative results per study and code."""
    low = (
        df.filter(F.col("RESULT") <= 0)
        .withColumn("type", F.when(F.col("RESULT") < 0, F.lit("Negative")).otherwise(F.lit("Zero")))
        .withColumn("Years", F.year("sampleDateTimeUTC"))
    )
    by = ["Study", "CodeName", "type"]
    texts = collapse_texts(low, by, ["Years", "Unified_Flag"], order)
    counts = low.groupBy(*by).agg(F.count("*").alias("count"))
    return null_safe_join(counts, texts.withColumnsRenamed({"Unified_Flag": "flags"}), by, "inner")


def mapping_gaps(df: DataFrame) -> DataFrame:
    """Per study: unmapped names, missing target units, differing units without a factor."""
    differs = (F.col("ReportedUnits") != F.col("TargetUnits")) & F.col("ConversionFactor").isNull()
    return df.groupBy("Study").agg(
        F.count_if(F.col("CodeName").isNull()).alias("unmapped"),
        F.count_if(F.col("TargetUnits").isNull()).alias("noTargetUnit"),
        F.count_if(differs).alias("noFactor"),
    )


def unmapped_names(df: DataFrame, name_map: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct source names the naming table does not know."""
    return null_safe_join(df.select(*on).distinct(), name_map.select(*on), list(on), "left_anti")


def duplicate_census(df: DataFrame, digits: int = 4, order: str = "Study") -> DataFrame:
    """Positions (rounded) that hold more than one row for a code and time."""
    rows = df.dropna(subset=["sampleDateTimeUTC", "Latitude", "CodeName", "sampleDepth"]).withColumns(
        {
            "Lat": round_half_even("Latitude", digits),
            "Lon": round_half_even("Longitude", digits),
        }
    )
    by = ["Lat", "Lon", "sampleDateTimeUTC", "CodeName", "sampleDepth"]
    repeated = rows.groupBy(*by).agg(F.count("*").alias("count")).filter(F.col("count") > 1)
    return null_safe_join(repeated, collapse_texts(rows, by, ["Study"], order), by, "inner")


def site_overlap(df: DataFrame, digits: Sequence[int]) -> DataFrame:
    """Positions rounded to each number of digits, with the sites there and whether several studies share them.

    Sites are made distinct before they are written once per level."""
    sites = df.select("Study", "SITE_ID", "Latitude", "Longitude").distinct()

    def rounded(column: str) -> Column:
        choices = [F.when(F.col("digits") == d, round_half_even(column, d)) for d in digits]
        return F.coalesce(*choices)

    levels = sites.withColumn("digits", F.explode(F.array(*[F.lit(d) for d in digits])))
    placed = levels.select(
        "digits",
        F.concat_ws("-", "Study", "SITE_ID").alias("SITE"),
        truncate_right("Study", 7).alias("Study"),
        rounded("Latitude").alias("Lat"),
        rounded("Longitude").alias("Lon"),
    ).distinct()
    return placed.groupBy("digits", "Lat", "Lon").agg(
        (F.count_distinct("Study") > 1).alias("multipleStudies"),
        F.count("*").alias("count"),
        F.array_join(F.sort_array(F.collect_set("SITE")), ", ").alias("studies"),
    )


def summary_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of several columns per group."""
    return df.groupBy(*by).agg(
        *[
            agg(c).alias(f"{c}_{label}")
            for c in columns
            for label, agg in (("mean", F.avg), ("sd", F.stddev_samp))
        ]
    )


def light_over_100(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share and number of light readings above 100 percent per group."""
    over = F.col("RESULT") > 100
    return df.filter(F.col("CodeName") == "CPAR").groupBy(*by).agg(
        F.count("*").alias("readings"),
        F.count_if(over).alias("over"),
        F.avg(over.cast("int")).alias("share"),
    )


def coverage(df: DataFrame, by: Sequence[str], study: str, kinds: dict[str, str]) -> DataFrame:
    """How many sites have more than one row of each kind of study, by combination.

    kinds: column of the result to the study it looks for."""
    per_site = df.groupBy(*by).agg(*[(F.count_if(F.col(study) == v) > 1).alias(k) for k, v in kinds.items()])
    return per_site.groupBy(*kinds).agg(F.count("*").alias("sites"))


def group_condition(
    df: DataFrame, by: Sequence[str], value: str, high: float, low: float, name: str
) -> DataFrame:
    """TRUE where the group has more than one value above `high` and more than one below `low`."""
    from .groups import with_group_stats

    return with_group_stats(
        df,
        list(by),
        **{
            name: (F.count_if(F.col(value) > high) > 1) & (F.count_if(F.col(value) < low) > 1),
        },
    )
