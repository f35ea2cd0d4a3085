"""Group statistics beside rows, fills, text collapse and first row per key.

Everything is a partial aggregate joined back to the rows (see
joins.join_statistics). Nothing here gathers a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import na_text
from .joins import join_statistics, null_safe_join


def with_group_stats(df: DataFrame, by: list[str], **stats: Column) -> DataFrame:
    """Group aggregates beside every row."""
    return join_statistics(df, _stats(df, by, stats), by)


def with_group_stats_shuffled(df: DataFrame, by: list[str], **stats: Column) -> DataFrame:
    """The same inside one job, for rows that are costly to compute twice.

    Rows and aggregates start from the same exchange; adaptive execution splits
    hot keys of the join.
    """
    return null_safe_join(df, _stats(df, by, stats), by)


def _stats(df: DataFrame, by: list[str], stats: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in stats.items()])


def fill_group_mean(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """NULL in each column becomes the group's mean of that column, in one pass."""
    out = with_group_stats(df, by, **{f"__mean_{c}": F.avg(c) for c in columns})
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__mean_{c}")) for c in columns})
    return out.drop(*[f"__mean_{c}" for c in columns])


def group_mode(df: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group; ties go to the smallest value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(
        F.count("*").alias("__n")
    )
    return counts.groupBy(*by).agg(
        F.min_by(column, F.struct(-F.col("__n"), F.col(column))).alias(name)
    )


def fill_group_mode(df: DataFrame, by: list[str], column: str, unknown: str = "none") -> DataFrame:
    """Replace the placeholder text by the group's most frequent value; NULL stays NULL."""
    out = join_statistics(df, group_mode(df, by, column, "__mode"), by)
    return out.withColumn(
        column, F.when(F.col(column) == unknown, F.col("__mode")).otherwise(F.col(column))
    ).drop("__mode")


def collapse_texts(df: DataFrame, by: list[str], columns: list[str], order: str) -> DataFrame:
    """Distinct texts per group joined by ', ' in first-seen order, NULL spelled 'NA'.

    Repeats are removed before the texts of a group meet, so the list built per
    group is its vocabulary, not its rows.
    """
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("col"), na_text(c).alias("text"))
            for i, c in enumerate(columns)
        ]
    )
    vocabulary = (
        df.select(*by, F.col(order).alias("__order"), F.inline(entries))
        .groupBy(*by, "col", "text")
        .agg(F.min("__order").alias("__first"))
    )

    def joined(i: int) -> Column:
        seen = F.sort_array(
            F.collect_list(F.when(F.col("col") == i, F.struct("__first", "text")))
        )
        return F.array_join(F.transform(seen, lambda s: s["text"]), ", ")

    return vocabulary.groupBy(*by).agg(*[joined(i).alias(c) for i, c in enumerate(columns)])


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Whole first row of each key in the stated order, by partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        .select(*key, "__row.*")
        .select(*df.columns)
    )


def mean_of_distinct(df: DataFrame, by: list[str], value: str, also: list[str], name: str) -> DataFrame:
    """Mean over distinct (by, also, value) tuples; rows without a value do not count."""
    tuples = df.filter(F.col(value).isNotNull()).select(*by, *also, value).distinct()
    return tuples.groupBy(*by).agg(F.avg(value).alias(name))
