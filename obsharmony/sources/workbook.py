"""Lab workbook of a monitoring programme and its nutrient supplement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.nulls import matches, paste
from ..functions.text import split_once, to_number
from ..operators import harmonize as hz
from ..operators.reshape import union_by_name, unpivot_long
from . import standard as st

# Limits given by the laboratory, in target units.
LAB_LIMITS = {"Tot_P": 0.2, "Part_P": 0.05}

# Fixed value: a mistyped Secchi reading.
SECCHI_TYPO = ("7..5", "7.5")

# Measured columns, name and unit joined by a dot.
VALUES = [
    "SurfaceTemp.C", "Secchi.m", "Chl.ugl", "TP.ugl", "TDP.ugl", "PP.ugl", "SRP.ugl",
    "SiO2.mgl", "NO3.mgl", "NH4.ugl", "Cl.mgl", "POC.mgl", "N.mgl",
]
SUPPLEMENT_VALUES = ["SRP.ugl", "SiO2.mgl"]

_IDS = ["Year", "Month", "Day", "SITE_ID", "sampleDepth", "Latitude", "Longitude", "stationDepth"]


def _date(df: DataFrame) -> DataFrame:
    whole = [F.col(c).cast("int") for c in ("Year", "Month", "Day")]
    return df.withColumn("sampleDate", times.parse_date(paste(*whole, sep="-"), "ymd"))


def _split_label(df: DataFrame) -> DataFrame:
    name, unit = split_once("label", r"\.")
    return df.withColumns({"ANALYTE": name, "ReportedUnits": unit}).drop("label")


def supplement(raw: DataFrame, aliases: DataFrame) -> DataFrame:
    df = raw.select(
        "Year", "Month", "Day", F.col("Station").alias("SITE_ID"), F.col("Depth").alias("sampleDepth"),
        *[F.col(f"`{c}`") for c in SUPPLEMENT_VALUES],
    )
    df = hz.resolve_alias(df, aliases)
    ids = [c for c in _IDS if c in df.columns]
    return _split_label(_date(unpivot_long(df, ids, SUPPLEMENT_VALUES, "label")))


def measurements(raw: DataFrame, aliases: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Main sheet to long form; Secchi 'bottom' becomes a flag without a value."""
    values = values or [c for c in VALUES if c in raw.columns]
    typo, right = SECCHI_TYPO
    secchi = F.when(F.col("`Secchi.m`") == typo, F.lit(right)).otherwise(F.col("`Secchi.m`"))
    bottom = matches(secchi, "bottom")
    cells = [
        (to_number(secchi) if c == "Secchi.m" else to_number(F.col(f"`{c}`"))).alias(c) for c in values
    ]
    df = raw.select(
        "Year", "Month", "Day", F.col("Station").alias("SITE_ID"),
        F.col("`Depth.m`").alias("sampleDepth"), *cells, bottom.alias("__bottom"),
    )
    df = hz.resolve_alias(df, aliases)
    ids = [c for c in _IDS if c in df.columns]
    df = unpivot_long(df, [*ids, "__bottom"], values, "label", drop_missing=False)
    df = hz.clear_to_bottom(df, F.col("__bottom") & (F.col("label") == "Secchi.m")).drop("__bottom")
    df = df.filter(F.col("RESULT").isNotNull() | F.col("QAcode").isNotNull())
    # Secchi has no sample depth, the surface thermometer is at zero.
    depth = F.when(F.col("label") == "SurfaceTemp.C", F.lit(0.0)).when(
        F.col("label") != "Secchi.m", F.col("sampleDepth")
    )
    return _split_label(_date(df.withColumn("sampleDepth", depth).distinct()))


def load(
    main: DataFrame, extra: DataFrame, aliases: DataFrame, lookups: st.Lookups,
    values: list[str] | None = None,
) -> DataFrame:
    aliases = aliases
    df = union_by_name(measurements(main, aliases, values), supplement(extra, aliases)).withColumn(
        "Study", F.lit(st.WORKBOOK)
    )
    whole = [F.col(c).cast("int") for c in ("Year", "Month", "Day")]
    uid = hz.uid("Study", "SITE_ID", *whole, st.number_text("sampleDepth"))
    df = df.withColumn("UID", uid)
    names = lookups.names["workbook"].select("Study", "ANALYTE", "CodeName")
    df = st.to_common_units(hz.map_names(df, names, ["Study", "ANALYTE"]), lookups)
    mdl = F.lit(None).cast("double")
    for code, limit in LAB_LIMITS.items():
        mdl = F.when(F.col("CodeName") == code, F.lit(limit)).otherwise(mdl)
    # A zero was never measured.
    df = df.withColumn("mdl", mdl).filter((F.col("RESULT") != 0) | F.col("QAcode").isNotNull())
    return st.as_observations(df)
