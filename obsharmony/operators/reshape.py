"""Wide/long reshaping."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import paste


def unpivot_long(
    df: DataFrame,
    ids: list[str],
    values: list[str],
    name: str = "ANALYTE",
    value: str = "RESULT",
    drop_missing: bool = True,
) -> DataFrame:
    """One row per (row, value column)."""
    quoted = [[F.col(f"`{c}`") for c in columns] for columns in (ids, values)]
    out = df.unpivot(*quoted, name, value)
    return out.filter(F.col(value).isNotNull()) if drop_missing else out


def unpivot_groups(df: DataFrame, required: str, pattern: str = r"^(.*)_(\d+)$") -> DataFrame:
    """Repeated groups PREFIX_k become one row per k with one column per prefix.

    Groups whose `required` column is empty are dropped. Columns that do not
    follow the pattern are kept beside every row; a prefix absent for some k is
    NULL there.
    """
    groups: dict[int, dict[str, str]] = {}
    prefixes: list[str] = []
    for c in df.columns:
        m = re.match(pattern, c)
        if m:
            groups.setdefault(int(m.group(2)), {})[m.group(1)] = c
            if m.group(1) not in prefixes:
                prefixes.append(m.group(1))
    grouped = {c for g in groups.values() for c in g.values()}
    fixed = [c for c in df.columns if c not in grouped]
    structs = [
        F.struct(
            F.lit(k).alias("Number"),
            *[
                (F.col(f"`{g[p]}`") if p in g else F.lit(None).cast("string")).alias(p)
                for p in prefixes
            ],
        )
        for k, g in sorted(groups.items())
    ]
    return df.select(*fixed, F.inline(F.array(*structs))).filter(F.col(required).isNotNull())


def pivot_wide(
    df: DataFrame, ids: list[str], names: list[str], name: list[str], value: str = "RESULT"
) -> DataFrame:
    """Mean of `value` per id and per name; `names` is the known list of output columns."""
    label = paste(*name, sep="_") if len(name) > 1 else F.col(name[0])
    return (
        df.select(*ids, label.alias("__name"), value)
        .groupBy(*ids)
        .pivot("__name", sorted(names))
        .agg(F.avg(value))
    )


def split_to_rows(df: DataFrame, column: str, separator: str) -> DataFrame:
    """One row per piece of a delimited text; a NULL text keeps its row."""
    return df.withColumn(column, F.explode_outer(F.split(F.col(column), separator)))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack by column name; a column missing on one side is NULL there.

    A shared column of two types is an error here, not a failing cast later.
    """
    types: dict[str, str] = {}
    for frame in frames:
        for c, t in frame.dtypes:
            if types.setdefault(c, t) != t:
                raise TypeError(f"column {c} is {types[c]} and {t}")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def blocks_to_long(
    df: DataFrame, fixed: list[str], blocks: dict[str, list[str]], tag: str
) -> DataFrame:
    """Unpivot several column blocks of one sheet, each tagged by its own tag column.

    `blocks` maps the tag column that opens a block to the value columns in it.
    All blocks are read in one pass.
    """
    entries = [
        F.struct(
            F.col(f"`{tag_column}`").cast("string").alias(tag),
            F.lit(c).alias("ANALYTE"),
            F.col(f"`{c}`").cast("string").alias("RESULT"),
        )
        for tag_column, columns in blocks.items()
        for c in columns
    ]
    return df.select(*fixed, F.inline(F.array(*entries)))
