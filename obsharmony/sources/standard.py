"""Study labels, lookup tables and the standard observation columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import harmonize as hz
from .readers import read_table

# Study labels as the naming and flag tables spell them.
LAB_DATABASE = "GLENDA"
AGENCY_CASTS = "SeaBird"
LAB_CASTS = "NOAActd"
WORKBOOK = "NOAA_WQ"
COASTAL_PROFILE_2010 = "NCCA_hydro_2010"
COASTAL_PROFILE_2015 = "NCCA_hydro_2015"
COASTAL_SECCHI_2015 = "NCCA_secchi_2015"
COASTAL_CHEMISTRY_2010 = "NCCA_WChem_2010"
COASTAL_CHEMISTRY_2015 = "NCCA_WChem_2015"
COASTAL_CHEMISTRY_2020 = "NCCA_WChem_2020"
COOP_2015 = "CSMI_2015"
COOP_2021_CHEMISTRY = "CSMI_2021_WQ"
COOP_2021_CASTS = "CSMI_2021_CTD"
COASTAL_PREFIX, COOP_PREFIX = "NCCA", "CSMI"

# Columns every source delivers, with their types.
OBSERVATION = {
    "UID": "string", "Study": "string", "SITE_ID": "string", "Latitude": "double",
    "Longitude": "double", "stationDepth": "double", "sampleDepth": "double",
    "sampleDate": "date", "sampleDateTime": "timestamp_ntz", "DEPTH_CODE": "string",
    "CodeName": "string", "ANALYTE": "string", "Category": "string", "LongName": "string",
    "Explicit_Units": "string", "RESULT": "double", "MDL": "double", "RL": "double",
    "TargetUnits": "string", "ReportedUnits": "string", "ConversionFactor": "double",
    "METHOD": "string", "LAB": "string", "QAcode": "string", "QAcomment": "string",
}

# Other spellings of the limit and site columns, in order of preference.
_SPELLINGS = {"RL": ["LRL", "MRL", "rl"], "MDL": ["MDL", "mdl"], "SITE_ID": ["SITE_ID", "STATION_ID"]}


def as_observations(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Standard columns in standard types; what a source lacks is NULL."""

    def cell(name: str, kind: str) -> Column:
        have = [c for c in [*_SPELLINGS.get(name, []), name] if c in df.columns]
        have = list(dict.fromkeys(have))
        c = F.coalesce(*[F.col(c) for c in have]) if have else F.lit(None)
        return c.cast(kind).alias(name)

    return df.select(*[cell(n, k) for n, k in OBSERVATION.items()], *extra)


def number_text(c: Column | str) -> Column:
    """Number as text without a trailing '.0'."""
    c = F.col(c) if isinstance(c, str) else c
    whole = c == F.floor(c)
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


@dataclass
class Lookups:
    """Naming maps per source family, key, conversions, limit names and flags.

    Each table is read once and its size checked once.
    """

    key: DataFrame
    conversions: DataFrame
    names: dict[str, DataFrame] = field(default_factory=dict)
    limit_names: DataFrame | None = None
    flags: DataFrame | None = None

    @classmethod
    def of(
        cls,
        key: DataFrame,
        conversions: DataFrame,
        names: dict[str, DataFrame],
        limit_names: DataFrame | None = None,
        flags: DataFrame | None = None,
    ) -> Lookups:
        """From raw sheets; coastal names fill missing codes, cooperative names lose their dots."""
        prepared = {
            family: hz.prepare_name_map(
                    sheet, fill_codes=family == "coastal", drop_dots=family == "coop"
                )
            for family, sheet in names.items()
        }
        return cls(
            hz.prepare_key(key),
            hz.prepare_conversions(conversions),
            prepared,
            None if limit_names is None else limit_names,
            flags,
        )

    @classmethod
    def read(cls, spark: SparkSession, paths: dict[str, str]) -> Lookups:
        families = [f for f in ("lab", "coastal", "coop", "workbook", "casts") if f"naming_{f}" in paths]
        flags = limit_names = None
        if "flags" in paths:
            flags = read_table(spark, paths["flags"])
            flags = (
                flags.withColumn("flag_row", F.col("flag_row").cast("int"))
                if "flag_row" in flags.columns
                else flags.withColumn("flag_row", F.monotonically_increasing_id())
            )
        if "limit_names" in paths:
            limit_names = read_table(spark, paths["limit_names"])
        return cls.of(
            read_table(spark, paths["key"]),
            read_table(spark, paths["conversions"]),
            {f: read_table(spark, paths[f"naming_{f}"]) for f in families},
            limit_names,
            flags,
        )


def to_common_units(
    df: DataFrame, lookups: Lookups, columns: Sequence[str] = ("RESULT",)
) -> DataFrame:
    """Key and conversion joins, then the conversion of the given columns."""
    return hz.convert_units(hz.add_key(df, lookups.key), lookups.conversions, columns)


