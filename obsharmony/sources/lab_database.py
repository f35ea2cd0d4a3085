"""Lab database: repeated column groups in wide rows, cleaned to observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, times
from ..functions.nulls import matches, paste
from ..operators import checks
from ..operators import harmonize as hz
from ..operators.joins import null_safe_join
from ..operators.reshape import unpivot_groups
from . import standard as st
from .readers import keep_samples

# Kept sample types and field samples; result texts that are no results.
SAMPLE_TYPES = ["Individual", "INSITU_MEAS"]
FIELD_SAMPLE = "routine field sample"
NO_RESULT = ["inv", "no result", "nrr", "lac"]
UNKNOWN_CODES = ["T", "W"]

# Seasons and years the limit sheet must cover.
SEASONS, FIRST_YEAR, LAST_YEAR = ["Spring", "Summer"], 1983, 2012
SURVEY_COLUMN = "Survey (Units)"

_NAME_KEYS = ["MEDIUM", "ANALYTE", "FRACTION", ("METHOD", "Methods")]


def read(wide: DataFrame, sample_ids: DataFrame | None = None) -> DataFrame:
    """Wide lab rows to one row per analysis, junk removed."""
    wide = wide.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns if c != "Row"])
    if sample_ids is not None:
        wide = keep_samples(wide, sample_ids)
    long = unpivot_groups(wide, required="ANALYTE")
    value = F.col("VALUE")
    # A row whose VALUE is missing does not pass the last two tests.
    keep = (
        F.col("SAMPLE_TYPE").isin(SAMPLE_TYPES)
        & (F.col("QC_TYPE") == FIELD_SAMPLE)
        & (value.isNotNull() | F.col("RESULT_REMARK").isNotNull())
        & ~matches("VALUE", "|".join(NO_RESULT), ignore_case=True)
        & ~value.isin(UNKNOWN_CODES)
    )
    return long.filter(keep & ~matches("DEPTH_CODE", "^integrated", ignore_case=True))


def sample_time(df: DataFrame) -> DataFrame:
    """UTC time from local text and a zone abbreviation; an unknown zone gives no time."""
    pattern = r"^(\d{4})/(\d{1,2})/(\d{1,2}) (\d{1,2}):(\d{2})"
    iso = F.regexp_replace("SAMPLING_DATE", pattern + ".*$", "$1-$2-$3 $4:$5:00")
    wall = F.when(F.col("SAMPLING_DATE").rlike(pattern), iso).try_cast("timestamp_ntz")
    zone = times.zone_name("TIME_ZONE")
    known = zone.isin("GMT", "UTC", *set(times.ZONE_NAMES.values()))
    df = df.withColumn("TIME_ZONE", F.when(known, zone))
    df = df.withColumn("sampleDateTime", times.to_utc(wall, F.col("TIME_ZONE")))
    return df.withColumn("sampleDate", F.col("sampleDateTime").cast("date"))


def limit_table(df: DataFrame, lookups: st.Lookups, limits: DataFrame) -> DataFrame:
    """Detection limits per season and reporting limits from '<x' results, stacked."""
    checks.require(
        df.filter(matches("VALUE", "^<")),
        ~matches("RESULT_REMARK", "reporting limit", ignore_case=True),
        "a '<' result is not marked as below the reporting limit",
    )
    reporting = hz.less_than_limits(
        df, lookups.names["lab"], lookups.key, lookups.conversions, _NAME_KEYS
    )
    detection = hz.season_limits(
        limits,
        SURVEY_COLUMN,
        lookups.limit_names,
        lookups.key,
        lookups.conversions,
        hz.season_grid(df.sparkSession, SEASONS, FIRST_YEAR, LAST_YEAR),
    )
    return detection.unionByName(reporting, allowMissingColumns=True)


def clean(
    df: DataFrame,
    lookups: st.Lookups,
    sites: DataFrame,
    limits: DataFrame,
    impute_coordinates: bool = True,
) -> DataFrame:
    """Lab analyses as standard observations, plus YEAR for the station-depth lookup."""
    df = sample_time(hz.fill_unknown_unit(df))
    season_limits = limit_table(df, lookups, limits)

    place = {"LATITUDE": "LATITUDE", "LONGITUDE": "LONGITUDE", "STN_DEPTH_M": "STN_DEPTH_M"}
    df = df.withColumns({c: text.to_number(c) for c in [*place, "SAMPLE_DEPTH_M"]})
    df = df.withColumn("SEASON", F.coalesce("SEASON", F.month("sampleDateTime").cast("string")))
    site_table = sites.select(
        F.col("Station").alias("STATION_ID"),
        text.to_number("Latitude").alias("LATITUDE"),
        text.to_number("Longitude").alias("LONGITUDE"),
    )
    if impute_coordinates:
        df = hz.fill_coordinates(df, "STATION_ID", list(place), site_table)
    else:
        spare = site_table.withColumnsRenamed({"LATITUDE": "__la", "LONGITUDE": "__lo"})
        df = null_safe_join(df, spare, ["STATION_ID"]).withColumns(
            {"LATITUDE": F.coalesce("LATITUDE", "__la"), "LONGITUDE": F.coalesce("LONGITUDE", "__lo")}
        )

    result = text.to_number("VALUE")
    df = df.withColumns(
        {
            "Study": F.lit(st.LAB_DATABASE),
            "QAcomment": F.when(result.isNull(), paste("RESULT_REMARK", F.lit("; "), "VALUE")).otherwise(
                F.col("RESULT_REMARK")
            ),
            "RESULT": result,
            "ReportedUnits": F.when(F.col("ANALYTE") == "pH", F.lit("unitless")).otherwise(
                text.unit_text("UNITS")
            ),
            "YEAR": text.to_number("YEAR"),
        }
    )
    df = hz.map_names(df, lookups.names["lab"], ["Study", *_NAME_KEYS])
    df = st.to_common_units(hz.respell_units(df, {"%": "percent"}), lookups)
    df = df.withColumn("RESULT", hz.silicon_to_silica("RESULT"))
    df = null_safe_join(df, season_limits, ["CodeName", "YEAR", "SEASON"])
    df = hz.zero_negative_rule(df).withColumnsRenamed(
        {
            "SAMPLE_ID": "UID",
            "SAMPLE_DEPTH_M": "sampleDepth",
            "STN_DEPTH_M": "stationDepth",
            "STATION_ID": "SITE_ID",
            "LATITUDE": "Latitude",
            "LONGITUDE": "Longitude",
        }
    )
    return st.as_observations(df, extra=["YEAR"])
