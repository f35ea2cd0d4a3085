"""Names, units, limits, sites and corrections on the long observation table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col, is_in, matches, na_text
from ..functions.numeric import ratio_percent
from ..functions.text import (
    base_name,
    extract_group,
    number_in_text,
    remove_all,
    replace_first,
    site_key,
    split_part,
    to_number,
    unit_text,
)
from ..session import durable
from .groups import collapse_texts, fill_group_mean, fill_group_mode, mean_of_distinct, with_group_stats
from .joins import null_safe_join
from .reshape import unpivot_long

# Fixed value: mass of silica per mass of silicon.
SILICON_TO_SILICA = 2.13918214

# Names whose results are silicon and must become silica.
SILICON_NAMES = ["Silicon, Elemental", "Silica, Dissolved as Si"]

# Remark given to zeros and negatives that are really non-detects.
BELOW_LIMIT_REMARK = "Method Detection Limit, less than"
ZERO_IS_NONDETECT = ["SRP", "Diss_P", "Chla", "Diss_NHx"]
NEGATIVE_IS_NONDETECT = ["Tot_P", "SRP", "Diss_NHx", "Diss_P", "Chla"]

# Text used when a station depth is taken from the deepest cast scan.
DEPTH_FROM_CAST = ("D", "station Depth estimated as the maximum CTD Depth")

# Text used for a disc that was visible on the lake floor.
CLEAR_TO_BOTTOM = ("CTB", "Secchi clear to bottom")

KEY_COLUMNS = ["CodeName", "TargetUnits", "LongName", "Category", "Explicit_Units"]


# --- lookup tables -----------------------------------------------------------
#
# Lookup tables reach these operators unmarked: from their size the optimizer decides
# whether to broadcast them or to shuffle.


def prepare_key(key: DataFrame) -> DataFrame:
    """Key sheet: CodeName with the target unit in conversion-table spelling."""
    out = key.withColumn("TargetUnits", unit_text("Units", remove_every_slash=False))
    return out.select(*[c for c in KEY_COLUMNS if c in out.columns])


def prepare_conversions(conversions: DataFrame) -> DataFrame:
    """Conversion sheet without its duplicate rows; bad factors become NULL."""
    return conversions.select(
        "ReportedUnits",
        "TargetUnits",
        to_number("ConversionFactor").alias("ConversionFactor"),
    ).distinct()


def prepare_name_map(name_map: DataFrame, fill_codes: bool = False, drop_dots: bool = False) -> DataFrame:
    """Naming sheet without its Units column; blanks and 'NA' are missing.

    fill_codes: a missing ANALYTE takes ANL_CODE and the other way round.
    drop_dots: remove dots from ANALYTE.
    """
    out = name_map.drop("Units")
    text = [c for c, t in out.dtypes if t == "string"]
    out = out.withColumns({c: F.when(~F.col(c).isin("", "NA"), F.col(c)) for c in text})
    if fill_codes:
        out = out.withColumns(
            {
                "ANALYTE": F.coalesce("ANALYTE", "ANL_CODE"),
                "ANL_CODE": F.coalesce("ANL_CODE", "ANALYTE"),
            }
        )
    return out.withColumn("ANALYTE", remove_all("ANALYTE", r"\.")) if drop_dots else out


# --- names and units ---------------------------------------------------------


def map_names(
    df: DataFrame, name_map: DataFrame, on: Sequence, strict: bool = False
) -> DataFrame:
    """Add CodeName by a left join on `on` and drop names marked for removal.

    Default: any spelling of "remove" is dropped, unmapped names stay.
    strict: only "Remove" is dropped, and unmapped names go with it.
    """
    keys = [(k, k) if isinstance(k, str) else k for k in on]
    table = name_map.select(*[r for _, r in keys], "CodeName")
    out = null_safe_join(df, table, keys)
    if strict:
        return out.filter(F.col("CodeName") != "Remove")
    return out.filter(~matches("CodeName", "remove", ignore_case=True))


def add_key(df: DataFrame, key: DataFrame) -> DataFrame:
    return null_safe_join(df, key, ["CodeName"])


def convert_units(
    df: DataFrame, conversions: DataFrame, columns: Sequence[str] = ("RESULT",)
) -> DataFrame:
    """Multiply the given columns by the factor for (ReportedUnits, TargetUnits), if there is one."""
    out = null_safe_join(df, conversions, ["ReportedUnits", "TargetUnits"])
    factor = F.col("ConversionFactor")
    return out.withColumns({c: F.coalesce(F.col(c) * factor, F.col(c)) for c in columns})


def override_units(df: DataFrame, units: Mapping[str, str], column: str = "ReportedUnits") -> DataFrame:
    """Set the unit of listed names."""
    unit = F.col(column)
    for name, text in units.items():
        unit = F.when(F.col("ANALYTE") == name, F.lit(text)).otherwise(unit)
    return df.withColumn(column, unit)


def respell_units(df: DataFrame, spelling: Mapping[str, str], column: str = "ReportedUnits") -> DataFrame:
    """Replace listed unit texts by the spelling of the conversion table."""
    unit = F.col(column)
    for old, new in spelling.items():
        unit = F.when(F.col(column) == old, F.lit(new)).otherwise(unit)
    return df.withColumn(column, unit)


def fill_unknown_unit(df: DataFrame, unit: str = "UNITS") -> DataFrame:
    """Unit 'none' becomes the commonest unit of the name, medium, fraction, method and year."""
    return fill_group_mode(df, ["ANALYTE", "MEDIUM", "FRACTION", "METHOD", "YEAR"], unit)


def silicon_to_silica(result: Column | str, analyte: Column | str = "ANALYTE") -> Column:
    result = as_col(result)
    return F.when(is_in(analyte, SILICON_NAMES), result * SILICON_TO_SILICA).otherwise(result)


def zero_negative_rule(df: DataFrame) -> DataFrame:
    """Zero and negative lab results of listed codes count as non-detects; turbidity stops at 0."""
    result, code = F.col("RESULT"), F.col("CodeName")
    bare = F.col("QAcomment").isNull()
    nondetect = ((result == 0) & code.isin(ZERO_IS_NONDETECT)) | (
        (result < 0) & code.isin(NEGATIVE_IS_NONDETECT)
    )
    return df.withColumns(
        {
            "QAcomment": F.when(bare & nondetect, F.lit(BELOW_LIMIT_REMARK)).otherwise(
                F.col("QAcomment")
            ),
            "RESULT": F.when((code == "Turb_NTU") & (result < 0), F.lit(0.0)).otherwise(result),
        }
    )


# --- detection and reporting limits -------------------------------------------


def less_than_limits(
    df: DataFrame, name_map: DataFrame, key: DataFrame, conversions: DataFrame, on: Sequence
) -> DataFrame:
    """Reporting limits stated as '<x' results, per year, season and code.

    Expects the rows to have passed `checks.require` on the remark text.
    """
    below = df.filter(matches("VALUE", "^<"))
    columns = ["YEAR", "SEASON", "ANALYTE", "VALUE", "UNITS", "MEDIUM", "FRACTION", "METHOD"]
    limits = below.select(*columns, "RESULT_REMARK").distinct()
    keys = [(k, k) if isinstance(k, str) else k for k in on]
    limits = null_safe_join(
        limits, name_map.select(*[r for _, r in keys], "CodeName"), keys
    )
    limits = limits.withColumns(
        {
            "VALUE": number_in_text("VALUE"),
            "YEAR": to_number("YEAR"),
            "ReportedUnits": unit_text("UNITS"),
        }
    )
    limits = convert_units(
        add_key(limits.drop("UNITS"), key.select("CodeName", "TargetUnits")), conversions, ["VALUE"]
    )
    return limits.select("YEAR", "SEASON", "CodeName", F.col("VALUE").alias("rl")).distinct()


def season_limits(
    table: DataFrame,
    survey: str,
    limit_names: DataFrame,
    key: DataFrame,
    conversions: DataFrame,
    seasons: DataFrame,
) -> DataFrame:
    """Limit sheet ('Spring 1999' rows, 'Name (unit)' columns) to one row per season, year and code.

    `seasons` lists the (SEASON, YEAR) pairs that must exist; missing ones get
    an empty limit. A limit of zero is unknown.
    """
    values = [c for c in table.columns if c != survey]
    survey_text = F.col(f"`{survey}`")
    wide = table.withColumns(
        {
            "SEASON": extract_group(survey_text, r"^(\S+)\s+(\S+)$", 1),
            "YEAR": to_number(extract_group(survey_text, r"^(\S+)\s+(\S+)$", 2)),
        }
    ).drop(survey)
    wide = null_safe_join(wide, seasons, ["SEASON", "YEAR"], "full")
    long = unpivot_long(wide, ["SEASON", "YEAR"], values, "label", "mdl_text", drop_missing=False)
    mdl = to_number("mdl_text")
    unit = F.lower(replace_first(extract_group("label", r"^(.*)\((.*)\)", 2), " .*/"))
    long = long.select(
        "SEASON",
        "YEAR",
        F.trim(replace_first(extract_group("label", r"^(.*)\(.*\)", 1), r"\(.*\)")).alias("ANALYTE"),
        F.when(mdl != 0, mdl).alias("mdl"),
        F.when(unit == "mgl", F.lit("mgl")).otherwise(F.lit("ugl")).alias("ReportedUnits"),
    )
    long = null_safe_join(long, limit_names.select("ANALYTE", "CodeName"), ["ANALYTE"])
    long = add_key(long, key.select("CodeName", "TargetUnits"))
    long = convert_units(long, conversions, ["mdl"])
    silica = F.col("CodeName") == "Diss_SiO2"
    return long.select(
        "YEAR",
        "SEASON",
        "CodeName",
        F.when(silica, F.col("mdl") * SILICON_TO_SILICA).otherwise(F.col("mdl")).alias("mdl"),
    )


def season_grid(spark, names: Sequence[str], first: int, last: int) -> DataFrame:
    """Every season name with every year."""
    years = spark.range(first, last + 1).select(F.col("id").cast("double").alias("YEAR"))
    return years.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("SEASON"), "YEAR")


# --- places --------------------------------------------------------------------


def fill_coordinates(df: DataFrame, site: str, columns: Sequence[str], table: DataFrame) -> DataFrame:
    """Missing position from the site's own mean, then from a site table (same column names)."""
    out = fill_group_mean(df, [site], list(columns))
    spare = [c for c in columns if c in table.columns]
    lookup = table.select(F.col(site), *[F.col(c).alias(f"__table_{c}") for c in spare])
    out = null_safe_join(out, lookup, [site])
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__table_{c}")) for c in spare})
    return out.drop(*[f"__table_{c}" for c in spare])


def site_depths(lab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean of distinct (depth, date) per site, and per site and year."""
    # Both means start from the same distinct tuples, kept once.
    known = lab.filter(F.col("stationDepth").isNotNull())
    tuples = durable(known.select("SITE_ID", "YEAR", "sampleDate", "stationDepth").distinct())
    return (
        mean_of_distinct(tuples, ["SITE_ID"], "stationDepth", ["sampleDate"], "siteDepth"),
        mean_of_distinct(tuples, ["SITE_ID", "YEAR"], "stationDepth", ["sampleDate"], "siteDepthYear"),
    )


def depth_from_cast(df: DataFrame, depth: Column, deepest: Column) -> DataFrame:
    """Station depth, else the deepest scan; the second case is marked in code and comment."""
    estimated = depth.isNull() & deepest.isNotNull()
    return df.withColumns(
        {
            "QAcode": F.when(estimated, F.lit(DEPTH_FROM_CAST[0])),
            "QAcomment": F.when(estimated, F.lit(DEPTH_FROM_CAST[1])),
            "stationDepth": F.coalesce(depth, deepest),
        }
    )


def station_depth_fallback(casts: DataFrame, lab: DataFrame) -> DataFrame:
    """Cast station depth from the lab table: site-year mean, site mean, deepest scan."""
    by_site, by_year = site_depths(lab)
    out = null_safe_join(casts.drop("stationDepth"), by_site, ["SITE_ID"])
    out = null_safe_join(out, by_year, ["SITE_ID", "YEAR"])
    out = depth_from_cast(out, F.coalesce("siteDepthYear", "siteDepth"), F.col("maxCTDdepth"))
    return out.drop("siteDepth", "siteDepthYear", "maxCTDdepth")


@dataclass(frozen=True)
class Correction:
    """A point correction: rows meeting `where` get the listed values."""

    where: Column
    set: Mapping[str, Any] = field(default_factory=dict)


def apply_corrections(df: DataFrame, rules: Sequence[Correction]) -> DataFrame:
    """Apply corrections in order; each sees the result of the ones before it."""
    for rule in rules:
        hit = F.coalesce(rule.where, F.lit(False))
        # The hit is fixed first, so a rule may change a column it tests.
        df = df.withColumn("__hit", hit)
        types = dict(df.dtypes)
        df = df.withColumns(
            {
                c: F.when(
                    F.col("__hit"),
                    v if isinstance(v, Column) else F.lit(v).cast(types[c]),
                ).otherwise(F.col(c))
                for c, v in rule.set.items()
            }
        ).drop("__hit")
    return df


def resolve_alias(df: DataFrame, aliases: DataFrame, site: str = "SITE_ID") -> DataFrame:
    """Site by alias: blanks, 'leg' and '#' stripped, then the alias table; unlisted sites go."""
    name = remove_all(F.lower(F.col(site)), r"[ \t]")
    name = replace_first(replace_first(name, "leg"), "#")
    table = aliases.filter(F.col("Keep") == "T").select(
        F.col("`Other.names`").alias("__alias"), F.col("SITE_ID").alias("__site"),
        *[c for c in ("Latitude", "Longitude", "stationDepth") if c in aliases.columns],
    )
    keep = [F.col(f"`{c}`") for c in df.columns if c != site]
    joined = null_safe_join(
        df.withColumn("__alias", F.when(name == "c1nobag", F.lit("c1")).otherwise(name)),
        table,
        ["__alias"],
        "inner",
    )
    extra = [c for c in table.columns if not c.startswith("__")]
    return joined.select(F.col("__site").alias(site), *keep, *extra)


def fix_site_typos(site: Column | str, typos: Mapping[str, str]) -> Column:
    """Lower-case site without underscores, listed wrong prefixes corrected."""
    out = site_key(site)
    for wrong, right in typos.items():
        out = F.regexp_replace(out, f"^{wrong}", right)
    return out


def cast_site(path: Column | str) -> Column:
    """Site from a cast file name: second '_' piece of the name, up to the first blank."""
    name = remove_all(base_name(path), r"(?i)\.cnv|\.bin")
    return split_part(split_part(name, "_", 2), " ", 1)


def first_casts(
    df: DataFrame, site: str, repeats: Sequence[str], aliases: Mapping[str, str]
) -> DataFrame:
    """Drop repeat casts by site text, rename listed first casts, drop derived files."""
    df = df.filter(~matches(site, "cast", True) & ~matches(site, ",") & ~is_in(site, repeats))
    name = F.col(site)
    for old, new in aliases.items():
        name = F.when(F.col(site) == old, F.lit(new)).otherwise(name)
    return df.withColumn(site, name).filter(~matches(site, "derive", True))


def in_water_bodies(df: DataFrame, lakes: Sequence[str] | None, column: str = "WTBDY_NM") -> DataFrame:
    """Keep listed water bodies; no list keeps everything."""
    return df if lakes is None else df.filter(F.col(column).isin(list(lakes)))


def in_plausible_range(c: Column | str, low: float, high: float) -> Column:
    c = as_col(c)
    return F.when((c >= low) & (c <= high), c)


# --- derived parameters --------------------------------------------------------


def _mean_of(name: str, value: str) -> Column:
    return F.avg(F.when(F.col("ANALYTE") == name, F.col(value)))


def oxidised_nitrogen(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    parts: tuple[str, str] = ("NITRITE_N", "NITRATE_N"),
    reported: str | None = None,
    limits: Sequence[str] = ("MDL", "LRL"),
    texts: Sequence[str] = ("METHOD", "LAB", "QAcode", "QAcomment"),
    name: str = "Diss_NOx",
) -> DataFrame:
    """Nitrite plus nitrate as one parameter, limits added too; replaces the two rows.

    Without a `reported` sum, samples where just one part has a value are
    dropped. With it, the reported value and limits win over the sums.
    """
    names = [*parts, *([reported] if reported else [])]
    values = ["RESULT", *limits]
    own = df.filter(F.col("ANALYTE").isin(names))
    means = {
        f"__{i}_{v}": _mean_of(n, v) for v in values for i, n in enumerate(names)
    }
    stats = own.groupBy(*by).agg(*[c.alias(k) for k, c in means.items()])
    if reported is None:
        one_only = F.col("__0_RESULT").isNull() != F.col("__1_RESULT").isNull()
        stats = stats.filter(~one_only)
    sums = {v: F.col(f"__0_{v}") + F.col(f"__1_{v}") for v in values}
    if reported:
        sums = {v: F.coalesce(F.col(f"__2_{v}"), s) for v, s in sums.items()}
    stats = stats.withColumns({**sums, "ANALYTE": F.lit(name)}).drop(*means)
    merged = [t for t in texts if t not in by]
    joined = collapse_texts(own, list(by), merged, order)
    derived = null_safe_join(stats, joined, list(by), "inner")
    if "METHOD" in merged:
        derived = derived.withColumn("METHOD", F.nullif(F.col("METHOD"), F.lit("NA")))
    rest = df.filter(~is_in("ANALYTE", names))
    return rest.unionByName(derived, allowMissingColumns=True)


def surface_light_percent(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    ambient: str = "Ambient PAR",
    underwater: str = "Underwater PAR",
    texts: Sequence[str] = ("QAcode", "QAcomment"),
    name: str = "Corrected PAR",
) -> DataFrame:
    """Underwater light in percent of surface light; replaces the two light parameters.

    Light under a surface without any is infinitely many percent and stays; without light
    on either side, or without one of the readings, there is no row.
    """
    pair = [ambient, underwater]
    own = df.filter(F.col("ANALYTE").isin(pair))
    stats = own.groupBy(*by).agg(
        _mean_of(ambient, "RESULT").alias("__a"), _mean_of(underwater, "RESULT").alias("__u")
    )
    endless = F.when(F.col("__u") > 0, F.lit(float("inf"))).when(F.col("__u") < 0, F.lit(float("-inf")))
    percent = F.when(F.col("__a") == 0, endless).otherwise(ratio_percent("__u", "__a"))
    share = stats.withColumn("RESULT", percent).drop("__a", "__u")
    share = share.filter(F.col("RESULT").isNotNull()).withColumns(
        {"ANALYTE": F.lit(name), "UNITS": F.lit("percent")}
    )
    derived = null_safe_join(share, collapse_texts(own, list(by), list(texts), order), list(by), "inner")
    return df.filter(~is_in("ANALYTE", pair)).unionByName(derived, allowMissingColumns=True)


def secchi_mean(df: DataFrame, by: Sequence[str], readings: Sequence[str]) -> DataFrame:
    """Mean of the readings of one visit; visits without any reading are dropped."""
    long = unpivot_long(df, list(by), list(readings), "reading", "RESULT")
    means = long.groupBy(*by).agg(F.avg("RESULT").alias("RESULT"))
    # Named only where there is a reading, so that the name stays a key of later joins and no constant.
    return means.withColumn("ANALYTE", F.when(F.col("RESULT").isNotNull(), F.lit("Secchi")))


def clear_to_bottom(df: DataFrame, clear: Column) -> DataFrame:
    """Mark readings that reached the lake floor."""
    return df.withColumns(
        {
            "QAcode": F.when(clear, F.lit(CLEAR_TO_BOTTOM[0])),
            "QAcomment": F.when(clear, F.lit(CLEAR_TO_BOTTOM[1])),
        }
    )


def with_deepest(df: DataFrame, by: Sequence[str], name: str, depth: str = "sampleDepth") -> DataFrame:
    """Deepest scan of the group beside every row."""
    return with_group_stats(df, list(by), **{name: F.max(depth)})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal in every column are kept once."""
    return df.distinct()


def uid(*parts: Column | str, sep: str = "-") -> Column:
    """Row id from its parts; a missing part is spelled 'NA'."""
    return F.concat_ws(sep, *[na_text(p) for p in parts])


def sentinel_to_null(c: Column | str, *values: float) -> Column:
    """Listed placeholder numbers become NULL."""
    c = as_col(c)
    return F.when(~c.isin(list(values)), c)


