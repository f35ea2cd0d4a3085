"""Cooperative surveys: the 2015 database tables and the 2021 sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.nulls import matches, paste
from ..functions.text import extract, extract_group, remove_all, replace_first, site_key, split_once, to_number
from ..operators import harmonize as hz
from ..operators.groups import fill_group_mean
from ..operators.joins import null_safe_join
from ..operators.ordered import quantiles
from ..operators.profiles import whole_metre_bins
from ..operators.reshape import union_by_name, unpivot_long
from . import standard as st
from .cast_files import BAD_VALUE

# Unit spellings and units by name of the 2015 tables.
UNITS_2015 = {"ugnl": "ug nl", "ugl_lach": "ugl", "ugl_sirms": "ugl", "pct": "percent"}
FORCED_UNITS_2015 = {"pH": "unitless", "Temptr": "c"}

# A mistyped latitude and layer keys filed under the wrong event.
WRONG_LATITUDE = ("Man_46", 46.0, 44.1116833333333)
WRONG_EVENT = (5008, 5015, "Fra_46_May_LE2")

# Survey prefixes of row ids, wrong site prefixes, one time written as a range.
AGENCY_ID, SURVEY_ID, LIGHT_ID = "EPActd", "USGSctd", "NBpar"
SURVEY_SUFFIX = "_USGS"
SITE_TYPOS = {"pwa": "pw", "lvd": "lud"}
TIME_RANGE = ("3:45 / 4:29", "4:07")
LATITUDE_RANGE, LONGITUDE_RANGE = (41.0, 47.0), (-88.0, -84.0)

# Columns of the 2021 agency cast sheet.
AGENCY_SITE, AGENCY_TIME = "X2", "X3"
AGENCY_DEPTH, AGENCY_LAT, AGENCY_LON = "Depth..fresh.water..m.", "Latitude..deg.", "Longitude..deg."
AGENCY_VALUES = {
    "Temperature..deg.C.": "Temperature..deg.C.",
    "Oxygen..mg.l.": "Oxygen..mg.l.",
    "Specific.Conductance..uS.cm.": "Specific.Conductance..uS.cm.",
    "CPAR.Corrected.Irradiance....": "cpar",
    "pH": "pH",
}


def _name_part(c: Column | str) -> Column:
    return extract(c, r"^\p{Alnum}*")


# --- 2015 ------------------------------------------------------------------------


def samples_2015(stations: DataFrame, events: DataFrame, layers: DataFrame) -> DataFrame:
    """Layer, event and station facts of every sample key."""
    site, limit, right = WRONG_LATITUDE
    wrong = (F.col("SITE_ID") == site) & (F.col("Latitude") > limit)
    clock = F.substring(F.col("TimeEST").cast("timestamp_ntz").cast("string"), 12, 8)
    local = F.concat(F.col("SampleDate").cast("date").cast("string"), F.lit(" "), clock)
    event = events.select(
        "SampleEventKey",
        F.col("StationCodeFK").alias("SITE_ID"),
        F.col("LatDD_actual").alias("Latitude"),
        F.col("LonDD_actual").alias("Longitude"),
        times.to_utc(local.try_cast("timestamp_ntz"), times.LOCAL_ZONE).alias("sampleDateTime"),
        F.col("DepthM_actual").alias("stationDepth"),
    ).withColumn("sampleDate", F.col("sampleDateTime").cast("date"))
    event = hz.apply_corrections(event, [hz.Correction(wrong, {"Latitude": right})])
    first, last, key = WRONG_EVENT
    layer = layers.select(
        F.col("STISkey").cast("string").alias("STIS"),
        F.col("SampleEventFK").alias("SampleEventKey"),
        F.col("WQdepth_m").alias("layerDepth"),
        F.col("ASTlayername").alias("sampleType"),
    )
    misfiled = F.col("STIS").try_cast("int").between(first, last)
    layer = hz.apply_corrections(layer, [hz.Correction(misfiled, {"SampleEventKey": key})])
    target = stations.select(
        F.col("StationCodeKey").alias("SITE_ID"),
        F.col("`DepthM _target`").alias("targetDepth"),
        F.col("LatDD_target").alias("targetLat"),
        F.col("LonDD_target").alias("targetLon"),
    )
    return null_safe_join(
        null_safe_join(layer, event, ["SampleEventKey"]), target, ["SITE_ID"]
    )


def limits_2015(raw: DataFrame, lookups: st.Lookups) -> DataFrame:
    df = raw.select(
        _name_part("WQParam").alias("ANALYTE"),
        F.lower(replace_first("WQUnits", "/")).alias("ReportedUnits"),
        F.col("DetectLimit").alias("mdl"),
        F.col("Analyst").alias("LAB"),
        F.col("AnalMethod").alias("METHOD"),
        F.lit(st.COOP_2015).alias("Study"),
    ).withColumn("mdl", to_number("mdl"))
    df = hz.map_names(df, lookups.names["coop"], ["Study", "ANALYTE"], strict=True)
    df = hz.override_units(df, FORCED_UNITS_2015)
    df = st.to_common_units(df, lookups, ["mdl"])
    return df.select("ANALYTE", "CodeName", "mdl", "LAB", "METHOD")


def load_2015(
    stations: DataFrame,
    events: DataFrame,
    layers: DataFrame,
    limits: DataFrame,
    chemistry: DataFrame,
    casts: DataFrame,
    lookups: st.Lookups,
) -> DataFrame:
    samples = samples_2015(stations, events, layers)

    def long(raw: DataFrame, key: str, depth: str | None, skip: Sequence[str]) -> DataFrame:
        values = [c for c in raw.columns if c not in {key, depth, *skip}]
        df = raw.withColumn("STIS", F.col(f"`{key}`").cast("string"))
        ids = ["STIS", *([depth] if depth else [])]
        return unpivot_long(df, ids, values, "label")

    chem = long(chemistry, "STIS#", None, ["Chem_site"])
    chem = null_safe_join(chem, samples, ["STIS"]).withColumnRenamed("layerDepth", "sampleDepth")
    cast = long(casts, "STISkey", "CTDdepth", [])
    cast = null_safe_join(cast, samples, ["STIS"]).drop("layerDepth")
    df = union_by_name(chem, cast.withColumnRenamed("CTDdepth", "sampleDepth"))
    df = df.filter(~matches("sampleType", "_cmp"))
    name, unit = split_once("label", "_")
    df = df.withColumns(
        {
            "ANALYTE": _name_part(name),
            "ReportedUnits": F.lower(unit),
            "Study": F.lit(st.COOP_2015),
            "UID": paste(F.lit(st.COOP_PREFIX), "STIS", sep="-"),
        }
    )
    df = hz.map_names(df, lookups.names["coop"], ["Study", "ANALYTE"])
    df = hz.override_units(df, {"pH": "unitless"})
    df = st.to_common_units(hz.respell_units(df, UNITS_2015), lookups)
    df = null_safe_join(df, limits_2015(limits, lookups), ["ANALYTE", "CodeName"])
    return st.as_observations(df)


# --- 2021 ------------------------------------------------------------------------


def _unit_2021(c: Column | str) -> Column:
    return F.lower(replace_first(replace_first(c, "[.]", " "), "/"))


def _label_2021(df: DataFrame) -> DataFrame:
    name, unit = split_once("label", r"\.")
    name = _name_part(name)
    return df.withColumns(
        {"ANALYTE": F.when(name == "chl", F.lit("chla")).otherwise(name), "UNITS": unit}
    ).drop("label")


def limits_2021(raw: DataFrame, lookups: st.Lookups) -> DataFrame:
    """One row of limits, a column per parameter."""
    df = raw.select(*[to_number(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    df = _label_2021(unpivot_long(df, [], df.columns, "label", "mdl", drop_missing=False))
    df = df.withColumns(
        {"Study": F.lit(st.COOP_2021_CHEMISTRY), "ReportedUnits": _unit_2021("UNITS")}
    )
    df = hz.map_names(df, lookups.names["coop"], ["Study", "ANALYTE"], strict=True)
    return st.to_common_units(df, lookups, ["mdl"]).select("ANALYTE", "CodeName", "TargetUnits", "mdl")


def agency_casts_2021(raw: DataFrame) -> DataFrame:
    """Agency casts with one median position per site and date.

    The instrument's mark for a missing value is no value.
    """

    def number(name: str) -> Column:
        return hz.sentinel_to_null(F.col(f"`{name}`").cast("double"), BAD_VALUE)

    df = raw.select(
        site_key(AGENCY_SITE).alias("SITE_ID"),
        times.serial_date(AGENCY_TIME).alias("sampleDate"),
        number(AGENCY_DEPTH).alias("sampleDepth"),
        hz.in_plausible_range(F.col(f"`{AGENCY_LAT}`"), *LATITUDE_RANGE).alias("lat"),
        hz.in_plausible_range(F.col(f"`{AGENCY_LON}`"), *LONGITUDE_RANGE).alias("lon"),
        *[number(c).alias(n) for c, n in AGENCY_VALUES.items()],
    )
    by = ["SITE_ID", "sampleDate"]
    for source, name in (("lat", "Latitude"), ("lon", "Longitude")):
        df = null_safe_join(df, quantiles(df.select(*by, source), by, source, {name: 0.5}), by)
    df = hz.with_deepest(df.drop("lat", "lon"), ["SITE_ID"], "SiteMaxCTDdepth")
    ids = [c for c in df.columns if c not in AGENCY_VALUES.values()]
    df = unpivot_long(df, ids, list(AGENCY_VALUES.values()), "label", drop_missing=False)
    shape = r"^(.*)\.\.(.*\..*)$"
    unit = remove_all(extract_group("label", shape, 2), r"[^%|\p{Alnum}]")
    name = remove_all(F.coalesce(extract_group("label", shape, 1), F.col("label")), r"\.")
    df = df.withColumns({"ANALYTE": name, "UNITS": unit}).drop("label")
    df = hz.override_units(df, {"cpar": "percent", "pH": "unitless"}, "UNITS")
    return hz.respell_units(df, {"degC": "C"}, "UNITS").withColumns(
        {
            "Study": F.lit(st.COOP_2021_CASTS),
            "UID": paste(F.lit(AGENCY_ID), "SITE_ID", st.number_text("sampleDepth"), sep="-"),
        }
    )


def survey_sites_2021(raw: DataFrame) -> DataFrame:
    return raw.select(
        site_key("TRANSECT").alias("SITE_ID"),
        F.col("BEG_LATITUDE_DD").alias("Latitude"),
        F.col("BEG_LONGITUDE_DD").alias("Longitude"),
        F.col("beg_depth").alias("stationDepth"),
    ).distinct()


def survey_casts_2021(raw: DataFrame) -> DataFrame:
    ids = ["Transect", "Serial", "Date", "Depth_m"]
    values = [c for c in raw.columns if c not in ids]
    df = unpivot_long(raw, ids, values, "label", drop_missing=False)
    name, unit = split_once("label", "_")
    df = df.select(
        site_key("Transect").alias("SITE_ID"),
        F.col("Depth_m").alias("sampleDepth"),
        times.parse_date("Date", "dmy").alias("sampleDate"),
        paste(F.lit(SURVEY_ID), paste("Transect", "Serial", sep="_"), sep="-").alias("UID"),
        F.concat(name, F.lit(SURVEY_SUFFIX)).alias("ANALYTE"),
        F.lower(remove_all(unit, "_")).alias("UNITS"),
        "RESULT",
        F.lit(st.COOP_2021_CASTS).alias("Study"),
    )
    return hz.override_units(df, {f"pH{SURVEY_SUFFIX}": "unitless"}, "UNITS")


def light_2021(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """Percent light per whole metre, only at sites of the survey casts."""
    hour, minute = times.decimal_hour("instrument_time")
    day = times.parse_date("Date", "ymd", time_may_follow=True)
    df = raw.select(
        F.col("Transect").alias("SITE_ID"),
        times.to_utc(times.at_time(day, hour, minute), times.LOCAL_ZONE).alias("sampleDateTime"),
        to_number("Depth_m").alias("sampleDepth"),
        F.col("`dc.pc.PAR`").alias("RESULT"),
    ).withColumn("sampleDate", F.col("sampleDateTime").cast("date"))
    df = whole_metre_bins(df, ["SITE_ID", "sampleDate"], "sampleDepth", "RESULT", "sampleDateTime")
    df = df.withColumn("SITE_ID", site_key("SITE_ID")).withColumns(
        {
            "Study": F.lit(st.COOP_2021_CASTS),
            "UNITS": F.lit("percent"),
            "ANALYTE": F.lit(f"cpar{SURVEY_SUFFIX}"),
            "UID": paste(F.lit(LIGHT_ID), "SITE_ID", st.number_text("sampleDepth"), sep="-"),
        }
    )
    return df.join(sites.select("SITE_ID").distinct(), "SITE_ID", "left_semi")


def chemistry_2021(raw: DataFrame, values: Sequence[str]) -> DataFrame:
    """Water chemistry with two spellings of the local time; negatives are flagged rows and go."""
    written, used = TIME_RANGE
    clock = F.trim(remove_all(F.col("`Time.(EST)`"), r"\(.*\)"))
    clock = F.when(clock == written, F.lit(used)).otherwise(clock)
    day = times.serial_date("Date")
    df = raw.withColumns({"__clock": clock, "__day": day})
    hour, minute = times.clock_parts("__clock")
    df = df.withColumn(
        "sampleDateTime", times.to_utc(times.at_time(F.col("__day"), hour, minute), times.LOCAL_ZONE)
    )
    df = df.select(
        F.col("`STIS#`").cast("string").alias("STIS"),
        F.col("Site").alias("SITE_ID"),
        F.coalesce(F.col("sampleDateTime").cast("date"), F.col("__day")).alias("sampleDate"),
        "sampleDateTime",
        F.col("`Site.Depth.(m)`").alias("stationDepth"),
        F.col("`Separate.depths.(m)`").alias("sampleDepth"),
        *[to_number(F.col(f"`{c}`")).alias(c) for c in values],
    )
    ids = ["STIS", "SITE_ID", "sampleDate", "sampleDateTime", "stationDepth", "sampleDepth"]
    df = _label_2021(unpivot_long(df, ids, list(values), "label"))
    return df.filter(F.col("RESULT") >= 0).withColumns(
        {
            "Study": F.lit(st.COOP_2021_CHEMISTRY),
            "UID": paste(F.lit(st.COOP_2021_CHEMISTRY), "STIS", sep="-"),
        }
    ).drop("STIS")


def load_2021(frames: Mapping[str, DataFrame], values: Sequence[str], lookups: st.Lookups) -> DataFrame:
    """frames: chemistry, limits, agency_casts, survey_casts, survey_sites, light."""
    sites = survey_sites_2021(frames["survey_sites"])
    survey = union_by_name(
        survey_casts_2021(frames["survey_casts"]), light_2021(frames["light"], sites)
    )
    survey = null_safe_join(survey, sites, ["SITE_ID"])
    df = union_by_name(
        chemistry_2021(frames["chemistry"], values), agency_casts_2021(frames["agency_casts"]), survey
    )
    df = df.withColumn("SITE_ID", hz.fix_site_typos("SITE_ID", SITE_TYPOS))
    df = hz.map_names(df, lookups.names["coop"], ["Study", "ANALYTE"])
    df = fill_group_mean(df, ["SITE_ID"], ["Latitude", "Longitude", "stationDepth"])
    df = hz.depth_from_cast(df, F.col("stationDepth"), F.col("SiteMaxCTDdepth"))
    df = df.withColumn("ReportedUnits", _unit_2021("UNITS"))
    df = st.to_common_units(df, lookups)
    limits = limits_2021(frames["limits"], lookups)
    df = null_safe_join(df, limits, ["ANALYTE", "CodeName", "TargetUnits"])
    return st.as_observations(
        df.withColumn("UID", paste(F.lit(st.COOP_PREFIX), "UID", sep="-"))
    )
