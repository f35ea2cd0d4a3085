"""Small lookup tables the queries share; each is a literal of known size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import inline_table, values_sql

NAME_MAP = (
    "ANALYTE VARCHAR, METHOD VARCHAR, CodeName VARCHAR",
    [
        ("click", None, "Tot_P"), ("click", "M0", "Tot_P"), ("click", "M1", "Diss_P"),
        ("view", None, "Chla"), ("view", "M0", "Chla"), ("view", "M1", "Remove"),
        ("purchase", None, "CPAR"), ("purchase", "M0", "CPAR"), ("purchase", "M1", "remove"),
        ("error", None, "Turb_NTU"), ("error", "M0", "Turb_NTU"),
        ("signup", None, "SRP"), ("signup", "M0", "SRP"), ("signup", "M1", "SRP"),
    ],
)
KEY = (
    "CodeName VARCHAR, Units VARCHAR, LongName VARCHAR, Category VARCHAR, Explicit_Units VARCHAR",
    [
        ("Tot_P", "ug/L", "Phosphorus, unfiltered", "Nutrients_Algae", "ug/L"),
        ("Diss_P", "ug/L", "Phosphorus, dissolved", "Nutrients_Algae", "ug/L"),
        ("Chla", "ug/L", "Chlorophyll-a", "Nutrients_Algae", "ug/L"),
        ("CPAR", "percent", "Photosynthetically active radiation (PAR) as % of surface",
         "Chemical_Physical", "percent"),
        ("Turb_NTU", "NTU", "Turbidity, Nephelometric Turbidity Units", "Clarity_Carbon", "NTU"),
        ("SRP", "ug/L", "Soluble reactive phosphorus (orthophosphate)", "Nutrients_Algae", "ug/L"),
    ],
)
CONVERSIONS = (
    "ReportedUnits VARCHAR, TargetUnits VARCHAR, ConversionFactor VARCHAR",
    [
        ("mgl", "ugl", "1000"), ("mgl", "ugl", "1000"),
        ("ug.pl", "ugl", "0.5"), ("ngl", "ugl", "0.001"), ("ugl", "mgl", "0.001"),
    ],
)
LIMITS = (
    "ANALYTE VARCHAR, MDL DOUBLE, RL DOUBLE",
    [("click", 5.0, 20.0), ("view", 2.0, None), ("purchase", None, 10.0), ("error", 1.0, 4.0)],
)
FLAGS = (
    "flag_row INTEGER, Study VARCHAR, QAcode VARCHAR, QAcomment VARCHAR, Definition VARCHAR, "
    "Unified_Flag VARCHAR, Unified_Comment VARCHAR, Retain VARCHAR, Action VARCHAR",
    [
        (1, "survey_0", "N", None, "non-detect", "N", "Below detection", "Keep", "NA out"),
        (2, "survey_0", "ND", None, "not detected", "N", "Below detection", "Keep", "NA out"),
        (3, "survey_0", None, "reporting limit", "below RL", "R", "Below Reporting Limit", "Keep", None),
        (4, "survey_0", "H", "held", "holding time", "H", "Holding time exceeded", "Keep", None),
        (5, "survey_0", "^E;", None, "estimate", "E", "Estimated value", None, None),
        (6, "survey_1", "Q", None, "quality issue", "Q", "Lab or field QC issue", "Keep", "flag"),
        (7, "survey_1", "ND", None, "bad sample", None, None, "Remove", "drop"),
        (8, "survey_1", None, "held (too|very) long", "late", "H", None, "Keep", None),
        (9, "survey_2", "Q|E", None, "either", "Q", "Lab or field QC issue", "Keep", None),
        (9, "survey_2", "Q|E", None, "either", "Q", "Lab or field QC issue", "Keep", None),
        (10, "survey_2", "H", None, None, "H", "Holding time exceeded", "Keep", None),
        (11, "survey_0", "MDL", None, "below MDL", "N", "Below detection", "Keep", None),
        (12, "survey_1", "Estimated", None, "between limits", "E", "Estimated value", "Keep", None),
        (14, "survey_1", "^D;", None, "depth from cast", "D", "Station depth estimated", "Keep", None),
        (13, "survey_2", "PAR", "surface PAR", "light", "P", "Corrected PAR exceeds 100%", "Keep", None),
    ],
)
SITE_ALIASES = (
    "alias VARCHAR, SITE_ID VARCHAR, Keep VARCHAR, Justification VARCHAR",
    [(f"s{i}", f"site-{i % 7}", "T" if i % 5 else "F", None) for i in range(0, 18)],
)


def lookup(spark: SparkSession, spec: tuple) -> DataFrame:
    return inline_table(spark, spec[1], spec[0])


def lookup_sql(spec: tuple) -> str:
    return values_sql(spec[1], spec[0])
