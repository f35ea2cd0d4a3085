"""Naming, key, conversion and flag sheets small enough to read, shared by the source tests."""

from __future__ import annotations

from obsharmony.sources import standard as st

KEY = "CodeName string, Units string, LongName string, Category string, Explicit_Units string"
KEY_ROWS = [
    ("Tot_P", "ug/L", "Phosphorus, unfiltered", "Nutrients_Algae", "ug/L"),
    ("Diss_NOx", "ug/L", "Oxidized nitrogen", "Nutrients_Algae", "ug/L"),
    ("Diss_SiO2", "mg/L", "Silica, dissolved", "Nutrients_Algae", "mg/L"),
    ("Chla", "ug/L", "Chlorophyll-a", "Nutrients_Algae", "ug/L"),
    ("pH", "unitless", "pH", "Chemical_Physical", "unitless"),
    ("Temp", "C", "Temperature", "Chemical_Physical", "C"),
    ("DO", "mg/L", "Oxygen, dissolved", "Chemical_Physical", "mg/L"),
    ("Cond", "uS/cm", "Specific conductivity", "Chemical_Physical", "uS/cm"),
    ("CPAR", "percent", "PAR", "Chemical_Physical", "percent"),
    ("Secchi", "m", "Secchi", "Clarity_Carbon", "m"),
    ("Tot_Mn", "ug/L", "Manganese, unfiltered", "Chemical_Physical", "ug/L"),
    ("SRP", "ug/L", "Soluble reactive phosphorus", "Nutrients_Algae", "ug/L"),
    ("Diss_NHx", "ug/L", "Ammonium", "Nutrients_Algae", "ug/L"),
]
CONVERSIONS = "ReportedUnits string, TargetUnits string, ConversionFactor string"
CONVERSION_ROWS = [
    ("mgl", "ugl", "1000"), ("mgl", "ugl", "1000"), ("ugl", "mgl", "0.001"), ("ug nl", "ugl", "1"),
    ("ug n/l", "ugl", "1"), ("ug nl", "ugl", "1"), ("m", "km", "bad"),
]
NAMES = "Study string, ANALYTE string, ANL_CODE string, Methods string, MEDIUM string, FRACTION string, CodeName string, Units string"


def name_rows(study, pairs, **extra):
    return [
        (study, a, extra.get("code"), extra.get("method"), extra.get("medium"), extra.get("fraction"), c, "x")
        for a, c in pairs
    ]


def lookups(frame, names: dict, limit_names=None, flags=None) -> st.Lookups:
    return st.Lookups.of(
        frame(KEY, KEY_ROWS),
        frame(CONVERSIONS, CONVERSION_ROWS),
        {family: frame(NAMES, rows) for family, rows in names.items()},
        limit_names,
        flags,
    )


LAB_NAMES = [
    ("GLENDA", "Total Phosphorus", None, "M1", "surface water", "Total", "Tot_P", "x"),
    ("GLENDA", "Manganese", None, None, "surface water", "Total", "Tot_Mn", "x"),
    ("GLENDA", "Silica, Dissolved as Si", None, "M1", "surface water", "Filtrate", "Diss_SiO2", "x"),
    ("GLENDA", "pH", None, "M1", "surface water", None, "pH", "x"),
    ("GLENDA", "Old thing", None, "M1", "surface water", None, "REMOVED", "x"),
    ("GLENDA", "SRP", None, "M1", "surface water", "Filtrate", "SRP", "x"),
]
FLAGS = (
    "flag_row int, Study string, QAcode string, QAcomment string, Definition string, "
    "Unified_Flag string, Unified_Comment string, Retain string, Action string"
)
