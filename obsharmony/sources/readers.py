"""Declared-type scans of CSV, Parquet and text, and the sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import to_number
from ..session import durable

# Logical input names a catalog must hold; every value is a path.
INPUTS = [
    "naming_lab", "naming_coastal", "naming_coop", "naming_workbook", "naming_casts",
    "key", "conversions", "limit_names", "flags",
    "coastal_profile_2010", "coastal_profile_2015", "coastal_secchi_2015",
    "coastal_sites_2010", "coastal_sites_2015", "coastal_chemistry_2010", "coastal_chemistry_2015",
    "lab_database", "lab_limits", "lab_sites",
    "agency_casts", "lab_casts",
    "coop_2015_stations", "coop_2015_events", "coop_2015_layers", "coop_2015_limits",
    "coop_2015_chemistry", "coop_2015_casts",
    "coop_2021_chemistry", "coop_2021_limits", "coop_2021_agency_casts", "coop_2021_survey_casts",
    "coop_2021_survey_sites", "coop_2021_light",
    "workbook", "workbook_supplement", "workbook_sites",
]


def _typed(c: Column, kind: str) -> Column:
    if kind == "string":
        return c.cast("string")
    if kind == "double":
        return to_number(c)
    if kind in ("int", "bigint"):
        return to_number(c).cast(kind)
    return c.cast("string").try_cast(kind)


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str] | None = None,
    null_values: Sequence[str] = ("NA",),
) -> DataFrame:
    """Scan one or several files of the same layout with declared types.

    `columns` maps wanted names to types; other columns are never read, bad
    numbers are NULL. Without it every column is text. Parquet by extension or
    folder of parquet, otherwise CSV with a header. `null_values` are the sheet's
    texts for a missing value.
    """
    paths = [path] if isinstance(path, str) else list(path)
    is_csv = paths[0].lower().rstrip("/").endswith((".csv", ".csv.gz"))
    if is_csv:
        df = spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(paths)
    else:
        df = spark.read.parquet(*paths)
    wanted = columns or {c: "string" for c in df.columns}
    lacking = [c for c in wanted if c not in df.columns]
    if lacking:
        raise ValueError(f"{paths[0]} has no column {lacking}")
    types = dict(df.dtypes)

    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if types[name] != "string":
            return c if types[name] == kind else c.cast(kind)
        return _typed(F.when(~c.isin("", *null_values), c), kind)

    return df.select(*[cell(n, k).alias(n) for n, k in wanted.items()])


def keep_samples(df: DataFrame, ids: DataFrame, column: str = "SAMPLE_ID") -> DataFrame:
    """Only the listed samples."""
    return df.join(ids.select(column).distinct(), column, "left_semi")


def in_file_order(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Number rows as scanned; used only to order joined texts."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_lines(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.cnv") -> DataFrame:
    """Text lines of all matching files below a folder: path, line_no (from 1), line.

    One scan writes the lines with their block of the file and their place in it; counts of
    the blocks, summed along the file, give each block its first number. A large file may be
    read in as many blocks as there are tasks.
    """
    scanned = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text([path] if isinstance(path, str) else list(path))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("__start"),
            F.monotonically_increasing_id().alias("__id"),
            F.col("value").alias("line"),
        )
    )
    raw = durable(scanned, "lines")
    blocks = raw.groupBy("path", "__start").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    earlier = W.partitionBy("path").orderBy("__start").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    number = F.col("__before") + F.col("__id") - F.col("__first") + 1
    return raw.join(blocks, ["path", "__start"]).select("path", number.alias("line_no"), "line")


def read_sheet_rows(
    spark: SparkSession, path: str, columns: Mapping[str, str], first: int = 1, last: int | None = None,
    pattern: str = "*.csv"
) -> DataFrame:
    """Rows `first` to `last` (from 1, the header not counted) of every CSV sheet below a folder.

    Adds `sheet` (the file) and `row_no`. Columns are found by each sheet's own header, in any
    order; wanted ones that a sheet lacks are NULL, and so are cells that are no such number.
    A quoted cell may not hold a line break.
    """
    lines = read_lines(spark, path, pattern)
    cells = _cells(F.col("line"))
    heads = lines.filter("line_no = 1").select("path", _cells(F.col("line")).alias("__names"))
    wanted = (F.col("line_no") > first) if last is None else F.col("line_no").between(first + 1, last + 1)
    rows = lines.filter(wanted).join(heads, "path").withColumn("__cells", cells)

    def cell(name: str, kind: str) -> Column:
        at = F.nullif(F.array_position("__names", name), F.lit(0).cast("bigint")).cast("int")
        text = F.try_element_at("__cells", at)
        return _typed(F.when(~text.isin("", "NA"), text), kind)

    return rows.select(
        F.col("path").alias("sheet"), (F.col("line_no") - 1).alias("row_no"), *[cell(c, k).alias(c) for c, k in columns.items()]
    )


def _cells(line: Column) -> Column:
    """Cells of a CSV line; a cell in quotes may hold commas, and doubled quotes stand for one."""
    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'("(?:[^"]|"")*"|[^,]*),'), 1)
    plain = lambda c: F.when(c.startswith('"'), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(found, plain)


def write_table(df: DataFrame, out: str, binary: bool = True) -> str:
    """Write Parquet or headed CSV; returns the folder written."""
    target = f"{out}.parquet" if binary else f"{out}.csv"
    writer = df.write.mode("overwrite")
    if binary:
        writer.parquet(target)
    else:
        writer.option("header", True).option("escape", '"').csv(target)
    return target


def _census(df: DataFrame) -> DataFrame:
    """Number of rows and an order-free checksum of their texts."""
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def write_checked(df: DataFrame, out: str, binary: bool = True) -> str:
    """write_table, with a manifest (rows, checksum) of what was to be written beside the table.

    The rows are kept first, so that the manifest and the table see the same ones."""
    rows = durable(df, "rows")
    target = write_table(rows, out, binary)
    _census(rows if binary else _as_text(rows)).write.mode("overwrite").json(f"{out}.manifest")
    return target


def _as_text(df: DataFrame) -> DataFrame:
    """What a CSV file says: texts, an empty one being missing."""
    return df.select(*[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def read_checked(spark: SparkSession, target: str, columns: Mapping[str, str] | None = None, **options) -> DataFrame:
    """read_table of a table that write_checked wrote; an error if it is not what was written."""
    out = target.removesuffix(".parquet").removesuffix(".csv")
    want = spark.read.schema("n long, checksum string").json(f"{out}.manifest").first()
    raw = read_table(spark, target, null_values=()) if target.endswith(".csv") else spark.read.parquet(target)
    got = _census(raw).first()
    if want is None or (got.n, got.checksum) != (want.n, want.checksum):
        raise ValueError(f"{target} holds {got.n} rows with checksum {got.checksum}, its manifest says {want}")
    return read_table(spark, target, columns, **options)
