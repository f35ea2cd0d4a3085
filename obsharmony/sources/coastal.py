"""Coastal survey: profiles, Secchi readings, water chemistry, sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.nulls import matches, paste
from ..functions.numeric import ratio_percent
from ..functions.text import replace_first
from ..operators import flags as fl
from ..operators import harmonize as hz
from ..operators.groups import collapse_texts, with_group_stats
from ..operators.joins import null_safe_join
from ..operators.reshape import union_by_name, unpivot_long
from . import standard as st
from .readers import in_file_order

# Casts kept from the 2010 profiles; sites whose site-table depth is the right one.
CASTS_2010 = ["DOWNCAST", "IM_CALC"]
SITE_TABLE_DEPTH = ["NCCAGL10-1095", "NCCAGL10-GLBA10-165"]

# One visit recorded a day early.
EARLY_VISIT = ("GLNS15-1340", 1)

# Units per parameter, from the survey's metadata.
PROFILE_UNITS_2015 = {
    "DO": "mgl", "TEMPERATURE": "c", "CONDUCTIVITY": "uscm", "Corrected PAR": "percent",
    "TRANS": "percent", "PH": "unitless",
}
CHEMISTRY_UNITS = {
    "COND": "uscm", "TKN": "mgL", "CHLORIDE": "mgL", "Alkalinity": "mgL", "SULFATE": "mgL",
    "PH": "unitless", "SILICA": "mgL", "Diss_NOx": "mgL", "SRP": "mgL", "CHLA": "ugL",
    "AMMONIA_N": "mgL", "PTL": "mgL", "DIN": "mgL", "NTL": "mgL",
}
WATER_SAMPLE_DEPTH = 0.5


def sites_2010(raw: DataFrame) -> DataFrame:
    return (
        raw.filter(F.col("NCCR_REG") == "Great Lakes")
        .select(
            "SITE_ID",
            F.col("ALAT_DD").alias("Latitude"),
            F.col("ALON_DD").alias("Longitude"),
            F.col("STATION_DEPTH").alias("siteDepth"),
            "WTBDY_NM",
        )
        .dropna()
    )


def sites_2015(raw: DataFrame) -> DataFrame:
    return (
        raw.select(
            "UID",
            "SITE_ID",
            F.col("LAT_DD83").alias("Latitude"),
            F.col("LON_DD83").alias("Longitude"),
            F.col("STATION_DEPTH").alias("siteDepth"),
            F.col("GREAT_LAKE").alias("WTBDY_NM"),
        )
        .dropna()
        .distinct()
    )


def _harmonise(
    df: DataFrame,
    lookups: st.Lookups,
    on: Sequence,
    strict: bool = False,
    columns: Sequence[str] = ("RESULT",),
) -> DataFrame:
    named = hz.map_names(df, lookups.names["coastal"], on, strict)
    return st.to_common_units(named, lookups, columns)


def profile_2010(raw: DataFrame, sites: DataFrame, lookups: st.Lookups) -> DataFrame:
    """Downcasts and calculated Secchi rows; light as percent of surface light."""
    df = in_file_order(raw).filter(
        matches("SITE_ID", "GL") & F.col("CAST").isin(CASTS_2010)
    ).select(
        "UID", "SITE_ID", "DATE_COL", "CAST",
        hz.sentinel_to_null("SDEPTH", -9.0).alias("sampleDepth"),
        F.col("`STATION_DEPTH(m)`").alias("stationDepth"),
        F.col("PARAMETER_NAME").alias("ANALYTE"),
        "RESULT", "UNITS",
        F.col("QA_CODE").alias("QAcode"),
        F.col("QA_COMMENT").alias("QAcomment"),
        "row_no",
    )
    df = hz.override_units(df, {"pH": "unitless", "Mean secchi": "m", "Turbidity": "unknown"}, "UNITS")
    by = ["UID", "SITE_ID", "DATE_COL", "CAST", "sampleDepth", "stationDepth", "ANALYTE"]
    means = df.groupBy(*by).agg(F.avg("RESULT").alias("RESULT"), F.min("row_no").alias("row_no"))
    texts = collapse_texts(df, by, ["UNITS", "QAcode", "QAcomment"], "row_no")
    df = null_safe_join(means, texts, by, "inner")
    visit = ["SITE_ID", "DATE_COL", "UID"]
    df = with_group_stats(df, visit, __deepest=F.max("stationDepth"))
    df = df.withColumn("stationDepth", F.col("__deepest")).drop("__deepest")
    df = df.withColumn("sampleDate", times.parse_date("DATE_COL", "mdy"))

    place = ["UID", "SITE_ID", "DATE_COL", "CAST", "sampleDepth", "stationDepth", "sampleDate"]
    df = hz.surface_light_percent(df, place, "row_no").drop("row_no")
    bad_disc = (F.col("RESULT") == -9) & (F.col("ANALYTE") == "Mean secchi")
    df = df.withColumn("RESULT", F.when(~F.coalesce(bad_disc, F.lit(False)), F.col("RESULT")))
    df = df.filter(F.col("RESULT").isNotNull() | F.col("QAcode").isNotNull())
    df = hz.override_units(df, {"Conductivity": "uscm"}, "UNITS").withColumns(
        {
            "Study": F.lit(st.COASTAL_PROFILE_2010),
            "ReportedUnits": F.lower(replace_first("UNITS", "/")),
        }
    )
    df = null_safe_join(df, sites, ["SITE_ID"])
    # The profile's own depth is right except at two sites.
    depth = F.when(F.col("SITE_ID").isin(SITE_TABLE_DEPTH), F.col("siteDepth"))
    df = df.withColumn("stationDepth", depth.otherwise(F.col("stationDepth")))
    return _harmonise(df.drop("siteDepth"), lookups, ["ANALYTE", "Study"])


def _with_site(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Position and depth from the site table, which wins over the file's depth."""
    df = null_safe_join(df.drop("stationDepth"), sites, ["UID", "SITE_ID"])
    return df.withColumnRenamed("siteDepth", "stationDepth")


def profile_2015(raw: DataFrame, sites: DataFrame, lookups: st.Lookups) -> DataFrame:
    df = raw.filter(F.col("CAST") == "DOWNCAST").select(
        "UID", "SITE_ID",
        times.serial_date("DATE_COL").alias("sampleDate"),
        F.col("DEPTH").alias("sampleDepth"),
        F.col("NARS_COMMENT").alias("QAcomment"),
        "TRANS", "CONDUCTIVITY", "DO", "PH", "TEMPERATURE",
        ratio_percent("LIGHT_UW", "LIGHT_AMB").alias("Corrected PAR"),
    )
    ids = ["UID", "SITE_ID", "sampleDate", "sampleDepth", "QAcomment"]
    df = unpivot_long(df, ids, list(c for c in df.columns if c not in ids))
    df = df.withColumns(
        {"Study": F.lit(st.COASTAL_PROFILE_2015), "ReportedUnits": F.lit(None).cast("string")}
    )
    df = hz.override_units(df, PROFILE_UNITS_2015)
    return _with_site(_harmonise(df, lookups, ["ANALYTE", "Study"]), sites)


def secchi_2015(raw: DataFrame, sites: DataFrame, lookups: st.Lookups) -> DataFrame:
    site, visit = EARLY_VISIT
    early = (F.col("SITE_ID") == site) & (F.col("VISIT_NO") == visit)
    df = raw.filter(
        ~matches("SECCHI_COMMENT", "missing for this site|unavailable for this site", True)
    )
    df = hz.apply_corrections(df, [hz.Correction(early, {"DATE_COL": F.col("DATE_COL") + 1})])
    df = df.withColumn("sampleDate", times.serial_date("DATE_COL"))
    by = ["UID", "sampleDate", "SITE_ID", "STATION_DEPTH", "VISIT_NO"]
    df = hz.secchi_mean(df, by, ["DISAPPEARS", "REAPPEARS"])
    df = _with_site(df.drop("STATION_DEPTH"), sites)
    df = hz.clear_to_bottom(df, F.col("RESULT") >= F.col("stationDepth")).withColumns(
        {"Study": F.lit(st.COASTAL_SECCHI_2015), "ReportedUnits": F.lit("m")}
    )
    return _harmonise(df, lookups, ["ANALYTE", "Study"])


def chemistry_2010(raw: DataFrame, lookups: st.Lookups) -> DataFrame:
    df = raw.filter(matches("SITE_ID", "GL")).select(
        "UID", "SITE_ID",
        times.parse_date("DATE_COL", "mdy").alias("sampleDate"),
        F.coalesce("PARAMETER", "PARAMETER_NAME").alias("ANL_CODE"),
        F.coalesce("PARAMETER_NAME", "PARAMETER").alias("ANALYTE"),
        "RESULT", "MDL", "MRL", "METHOD",
        F.col("QACODE").alias("QAcode"),
        F.lower(replace_first("UNITS", "/")).alias("ReportedUnits"),
        F.lit(WATER_SAMPLE_DEPTH).alias("sampleDepth"),
        F.lit(st.COASTAL_CHEMISTRY_2010).alias("Study"),
    )
    on = ["Study", "ANALYTE", "ANL_CODE", ("METHOD", "Methods")]
    return _harmonise(df, lookups, on, strict=True, columns=["RESULT", "MDL", "MRL"])


def chemistry_2015(raw: DataFrame, sites: DataFrame, lookups: st.Lookups) -> DataFrame:
    """Nitrite and nitrate become oxidised nitrogen; texts are tidied; sites give the position."""
    df = in_file_order(raw).select(
        "UID", "SITE_ID", "LAB", "ANALYTE", "LRL", "MDL", "METHOD", "RESULT", "SAMPLE_ID",
        times.parse_date("DATE_COL", "dmy").alias("sampleDate"),
        F.col("NARS_FLAG").alias("QAcode"),
        F.col("NARS_COMMENT").alias("QAcomment"),
        F.col("RESULT_UNITS").alias("ReportedUnits"),
        "row_no",
    )
    df = hz.oxidised_nitrogen(df, ["UID", "SITE_ID", "LAB", "sampleDate", "SAMPLE_ID"], "row_no")
    # A parameter outside the list has no unit.
    df = df.withColumn("ReportedUnits", F.lit(None).cast("string"))
    df = hz.override_units(df, CHEMISTRY_UNITS).withColumns(
        {
            "ReportedUnits": F.lower("ReportedUnits"),
            "sampleDepth": F.lit(WATER_SAMPLE_DEPTH),
            "Study": F.lit(st.COASTAL_CHEMISTRY_2015),
        }
    )
    df = _with_site(fl.clean_qa_text(df), sites)
    on = ["Study", "ANALYTE", ("METHOD", "Methods")]
    return _harmonise(df, lookups, on, strict=True, columns=["RESULT", "MDL", "LRL"])


def chemistry_2020(raw: DataFrame, sites: DataFrame, lookups: st.Lookups) -> DataFrame:
    """Optional 2020 chemistry: a reported nitrite-plus-nitrate wins over the sum.

    Off by default, as the survey's own pipeline leaves this year out.
    """
    df = in_file_order(raw).select(
        "UID", "SITE_ID", "LAB", "ANALYTE", "RL", "MDL", "RESULT",
        times.parse_date("DATE_COL", "mdy").alias("sampleDate"),
        F.col("NARS_FLAG").alias("QAcode"),
        F.col("NARS_COMMENT").alias("QAcomment"),
        "row_no",
    )
    df = hz.oxidised_nitrogen(
        df,
        ["UID", "SITE_ID", "LAB", "sampleDate"],
        "row_no",
        reported="NITRATE_NITRITE_N",
        limits=("MDL", "RL"),
        texts=("QAcode", "QAcomment"),
    )
    units = {k: v for k, v in CHEMISTRY_UNITS.items() if k != "NTL"}
    df = hz.override_units(df.withColumn("ReportedUnits", F.lit(None).cast("string")), units)
    df = df.withColumns(
        {
            "ReportedUnits": F.lower("ReportedUnits"),
            "sampleDepth": F.lit(WATER_SAMPLE_DEPTH),
            "Study": F.lit(st.COASTAL_CHEMISTRY_2020),
        }
    )
    df = null_safe_join(df, sites, ["UID", "SITE_ID"]).filter(F.col("Longitude").isNotNull())
    return _harmonise(df, lookups, ["Study", "ANALYTE"], strict=True, columns=["RESULT", "MDL", "RL"])


def combine(
    profiles_2010: DataFrame,
    others: Sequence[DataFrame],
    chem_2010: DataFrame,
    lakes: Sequence[str] | None = None,
) -> DataFrame:
    """All coastal tables; 2010 chemistry takes its site facts from the 2010 profiles."""
    facts = ["SITE_ID", "UID", "Latitude", "Longitude", "stationDepth", "WTBDY_NM"]
    places = profiles_2010.select(*facts).distinct()
    chem_2010 = null_safe_join(chem_2010, places, ["SITE_ID", "UID"])
    frames = [
        st.as_observations(
            df.withColumn("UID", paste(F.lit(st.COASTAL_PREFIX), st.number_text("UID"), sep="-")),
            extra=["WTBDY_NM"],
        )
        for df in [profiles_2010, *others, chem_2010]
    ]
    return hz.in_water_bodies(union_by_name(*frames), lakes).drop("WTBDY_NM")
