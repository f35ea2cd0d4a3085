"""Preprocessed instrument casts of two agencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.nulls import matches
from ..functions.text import unit_text
from ..operators import harmonize as hz
from ..operators.profiles import prefer_instrument
from . import standard as st

# Repeat casts to drop and first casts to rename.
REPEAT_CASTS = ["MI18MB", "MI27M-B", "MI27MB", "MI41M-B", "MI41MB"]
FIRST_CASTS = {
    "MI18MA": "MI18M", "MI27M-A": "MI27M", "MI27MA": "MI27M", "MI41M-A": "MI41M", "MI41MA": "MI41M",
}

# Files whose site cannot be told.
UNCLEAR_FILES = (
    "302_102913_0758_M45_day|302_10292013_0758_M45_night|302_102913_0758_M110x"
)

# True place of sites that were swapped or read from the wrong part of a file name.
ALPHA = {"SITE_ID": "alpha", "stationDepth": 18.0, "Latitude": 43.18816667, "Longitude": -86.344}
BETA = {"SITE_ID": "beta", "stationDepth": 45.0, "Latitude": 43.20616667, "Longitude": -86.44966667}
OMEGA = {"SITE_ID": "omega", "stationDepth": 110.0, "Latitude": 43.19983333, "Longitude": -86.56983333}
SWAP_DATE = "2019-12-16"


def agency_casts(raw: DataFrame, lookups: st.Lookups) -> DataFrame:
    """Agency casts: site from the file name, first casts only, light in percent.

    Station depth is left to the lab table (see station_depth_fallback); the
    deepest scan per site comes along as maxCTDdepth, with YEAR.
    """
    df = raw.withColumn("SITE_ID", hz.cast_site("STATION_ID")).drop("STATION_ID")
    date = F.col("sampleDateTime").cast("date")
    unit = F.when(F.col("ANALYTE") == "cpar", F.lit("percent")).when(
        F.col("ANALYTE") == "pH", F.lit("unitless")
    )
    df = df.withColumns(
        {
            "Study": F.lit(st.AGENCY_CASTS),
            "__place": hz.uid("SITE_ID", date, st.number_text("sampleDepth"), sep="_"),
            "ReportedUnits": unit_text(unit.otherwise(F.col("UNITS"))),
        }
    )
    df = hz.first_casts(df, "SITE_ID", REPEAT_CASTS, FIRST_CASTS)
    df = df.filter(F.col("RESULT").isNotNull())
    df = st.to_common_units(
        hz.map_names(df, lookups.names["casts"], ["Study", "ANALYTE"]), lookups
    )
    df = df.withColumns(
        {
            "sampleDate": date,
            "YEAR": F.year("sampleDateTime").cast("double"),
            "UID": hz.uid("Study", "__place", sep="_"),
            "RESULT": F.when(F.col("CodeName") == "CPAR", F.col("RESULT") * 100).otherwise(
                F.col("RESULT")
            ),
        }
    )
    df = hz.with_deepest(df, ["SITE_ID"], "maxCTDdepth")
    return st.as_observations(df, extra=["YEAR", "maxCTDdepth"])


def lab_casts(raw: DataFrame, lookups: st.Lookups) -> DataFrame:
    """Lab casts: instrument metadata first, wrong century and wrong sites corrected.

    Instrument columns carry the suffix '_ctd'.
    """
    df = prefer_instrument(raw)
    df = df.withColumns(
        {
            "sampleDateTime": times.fix_century("sampleDateTime"),
            "Study": F.lit(st.LAB_CASTS),
            "ReportedUnits": F.lower("UNITS"),
        }
    )
    names = lookups.names["workbook"].filter(F.col("Study") == st.LAB_CASTS)
    names = names.select("Study", "ANALYTE", "CodeName").distinct()
    df = st.to_common_units(hz.map_names(df, names, ["Study", "ANALYTE"]), lookups)
    df = df.filter(F.col("RESULT").isNotNull()).withColumn(
        "sampleDate", F.col("sampleDateTime").cast("date")
    )

    def swapped(file: str, site: str):
        on_date = F.col("sampleDate") == F.lit(SWAP_DATE).cast("date")
        return on_date & F.col("ctdFiles").contains(file) & (F.col("SITE_ID") == site)

    # Sites first, then places: the second pair sees the corrected site.
    df = hz.apply_corrections(
        df,
        [
            hz.Correction(swapped("M45", "beta"), {"SITE_ID": F.lit("omega*")}),
            hz.Correction(swapped("M110", "omega"), {"SITE_ID": "beta"}),
            hz.Correction(F.col("SITE_ID") == "omega*", {"SITE_ID": "omega"}),
            hz.Correction(swapped("M45", "omega"), OMEGA),
            hz.Correction(swapped("M110", "beta"), BETA),
        ],
    )
    df = df.filter(~matches("ctdFiles", UNCLEAR_FILES))
    df = hz.apply_corrections(
        df,
        [
            hz.Correction(matches("ctdFiles", "M15d1730.cnv"), ALPHA),
            hz.Correction(matches("ctdFiles", "M45d1925.cnv"), BETA),
        ],
    )
    uid = hz.uid("Study", "SITE_ID", "sampleDate", st.number_text("sampleDepth"), sep="_")
    return st.as_observations(df.withColumn("UID", uid))
