"""The whole job: sources to one harmonised observation table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..operators import flags as fl
from ..operators import harmonize as hz
from ..operators.reshape import union_by_name
from ..sources import casts, coastal, cooperative, lab_database, workbook
from ..sources import standard as st
from ..sources.readers import read_table, write_table

# Columns of the result, in order.
FINAL = [
    "UID", "Study", "SITE_ID", "Latitude", "Longitude", "stationDepth", "sampleDate",
    "sampleDateTimeUTC", "sampleDepth", "DEPTH_CODE", "CodeName", "LongName", "Category",
    "ANALYTE_Orig_Name", "RESULT", "MDL", "RL", "Units", "ReportedUnits", "ConversionFactor",
    "Unified_Flag", "Unified_Comment", "METHOD", "LAB", "Orig_QAcode", "Orig_QAcomment",
    "Orig_QAdefinition",
]
SORT = ["sampleDate", "sampleDateTimeUTC", "SITE_ID", "sampleDepth", "LongName"]

# Fixed value: texts for a missing value in sheets that do not spell it 'NA'.
NULL_TEXTS = {"coop_2021_agency_casts": ("-9.99e-29",)}

# Fixed value: lakes in the published table.
LAKES = ["Lake Michigan"]


def finish(observations: DataFrame, flags: DataFrame) -> DataFrame:
    """Standard observations to the final table, unsorted.

    Limit labels, unified flags, censoring and the local sample date. Repeated
    source rows are kept once, and so are flagged rows that became equal by the
    tidying of their texts; both rules share the only shuffle of whole rows:
    unflagged rows are compared by what the source said, flagged rows by the
    outcome.
    """
    df = observations.select(*st.OBSERVATION).withColumnRenamed("sampleDateTime", "sampleDateTimeUTC")
    df = df.withColumn("__source", F.struct("RESULT", "QAcode", "QAcomment"))
    df = fl.match_flags(fl.limit_flags(df), flags)
    df = df.withColumn("__source", F.when(fl.no_flag(), F.col("__source")))
    df = hz.drop_duplicates(df).drop("__source")
    df = df.withColumns(
        {
            "RESULT": fl.censor(),
            "sampleDate": F.coalesce(times.local_date("sampleDateTimeUTC"), F.col("sampleDate")),
        }
    ).withColumnsRenamed(
        {
            "ANALYTE": "ANALYTE_Orig_Name",
            "Explicit_Units": "Units",
            "QAcode": "Orig_QAcode",
            "QAcomment": "Orig_QAcomment",
            "Definition": "Orig_QAdefinition",
        }
    )
    return df.select(*FINAL)


def ordered(df: DataFrame) -> DataFrame:
    """Report order, missing values last; the id settles ties and splits long runs."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in [*SORT, "UID"]])


def combine(
    lab: DataFrame, agency_casts: DataFrame, others: Sequence[DataFrame]
) -> DataFrame:
    """All sources by name; agency casts take their station depth from the lab table."""
    deep = hz.station_depth_fallback(agency_casts, lab)
    frames = [lab.select(*st.OBSERVATION), deep.select(*st.OBSERVATION)]
    return union_by_name(*frames, *[o.select(*st.OBSERVATION) for o in others])


def _read_all(spark: SparkSession, paths: Mapping[str, str]):
    def text(name: str, **types: str) -> DataFrame:
        """A source table, text unless a type is declared."""
        raw = read_table(spark, paths[name])
        return raw.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})

    return text


def load_coastal(
    spark: SparkSession, paths: Mapping[str, str], lookups: st.Lookups,
    lakes: Sequence[str] | None,
) -> DataFrame:
    read = _read_all(spark, paths)
    sites10 = coastal.sites_2010(
        read("coastal_sites_2010", ALAT_DD="double", ALON_DD="double", STATION_DEPTH="double")
    )
    sites15 = coastal.sites_2015(
        read("coastal_sites_2015", UID="double", LAT_DD83="double", LON_DD83="double", STATION_DEPTH="double")
    )
    profile10 = coastal.profile_2010(
        read("coastal_profile_2010", **{c: "double" for c in ("UID", "SDEPTH", "STATION_DEPTH(m)", "RESULT")}),
        sites10,
        lookups,
    )
    numbers = ["UID", "DEPTH", "TRANS", "CONDUCTIVITY", "DO", "PH", "TEMPERATURE", "LIGHT_AMB", "LIGHT_UW"]
    profile15 = coastal.profile_2015(
        read("coastal_profile_2015", DATE_COL="int", **{c: "double" for c in numbers}), sites15, lookups
    )
    numbers = ["UID", "STATION_DEPTH", "DISAPPEARS", "REAPPEARS"]
    secchi = coastal.secchi_2015(
        read("coastal_secchi_2015", VISIT_NO="int", DATE_COL="int", **{c: "double" for c in numbers}),
        sites15,
        lookups,
    )
    chem10 = coastal.chemistry_2010(
        read("coastal_chemistry_2010", **{c: "double" for c in ("UID", "RESULT", "MDL", "MRL")}), lookups
    )
    chem15 = coastal.chemistry_2015(
        read("coastal_chemistry_2015", **{c: "double" for c in ("UID", "RESULT", "MDL", "LRL")}),
        sites15,
        lookups,
    )
    return coastal.combine(profile10, [profile15, secchi, chem15], chem10, lakes)


def load_cooperative(
    spark: SparkSession, paths: Mapping[str, str], lookups: st.Lookups, values_2021: Sequence[str]
) -> DataFrame:
    def read(name: str, numbers: Sequence[str] = (), rest_from: str | None = None, **types: str) -> DataFrame:
        raw = read_table(spark, paths[name], null_values=NULL_TEXTS.get(name, ("NA",)))
        if rest_from is not None:
            numbers = raw.columns[raw.columns.index(rest_from) :]
        casts_ = {c: "double" for c in numbers} | types
        return raw.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in casts_.items()})

    chem15 = read("coop_2015_chemistry")
    casts15 = read("coop_2015_casts")
    y2015 = cooperative.load_2015(
        read("coop_2015_stations", ["DepthM _target", "LatDD_target", "LonDD_target"]),
        read("coop_2015_events", ["LatDD_actual", "LonDD_actual", "DepthM_actual"]),
        read("coop_2015_layers", ["WQdepth_m"]),
        read("coop_2015_limits"),
        chem15.withColumns(
            {c: F.col(f"`{c}`").try_cast("double") for c in chem15.columns if c not in ("STIS#", "Chem_site")}
        ),
        casts15.withColumns(
            {c: F.col(f"`{c}`").try_cast("double") for c in casts15.columns if c != "STISkey"}
        ),
        lookups,
    )
    y2021 = cooperative.load_2021(
        {
            "chemistry": read("coop_2021_chemistry", ["Site.Depth.(m)", "Separate.depths.(m)"], Date="double"),
            "limits": read("coop_2021_limits"),
            "agency_casts": read(
                "coop_2021_agency_casts",
                [cooperative.AGENCY_TIME, cooperative.AGENCY_DEPTH, cooperative.AGENCY_LAT,
                 cooperative.AGENCY_LON, *cooperative.AGENCY_VALUES],
            ),
            "survey_casts": read("coop_2021_survey_casts", rest_from="Depth_m"),
            "survey_sites": read(
                "coop_2021_survey_sites", ["BEG_LATITUDE_DD", "BEG_LONGITUDE_DD", "beg_depth"]
            ),
            "light": read("coop_2021_light", ["instrument_time", "dc.pc.PAR"]),
        },
        values_2021,
        lookups,
    )
    return union_by_name(y2015, y2021)


def assemble(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: str | None = None,
    binary: bool = True,
    lakes: Sequence[str] | None = tuple(LAKES),
    values_2021: Sequence[str] | None = None,
) -> DataFrame:
    """Read every source in the catalog, harmonise, flag, censor; optionally write.

    `paths` names one file or folder per logical input (see readers.INPUTS).
    """
    lookups = st.Lookups.read(spark, dict(paths))
    read = _read_all(spark, paths)

    lab = lab_database.clean(
        lab_database.read(read("lab_database")), lookups, read("lab_sites"), read("lab_limits")
    )
    place = {c: "double" for c in ("sampleDepth", "stationDepth", "Latitude", "Longitude", "RESULT")}
    agency = casts.agency_casts(
        read("agency_casts", sampleDateTime="timestamp_ntz", **place), lookups
    )
    instrument = {f"{c}_ctd": "double" for c in ("Latitude", "Longitude", "stationDepth")}
    lab_ctd = casts.lab_casts(
        read(
            "lab_casts", sampleDateTime="timestamp_ntz", sampleDateTime_ctd="timestamp_ntz",
            **place, **instrument,
        ),
        lookups,
    )
    aliases = read("workbook_sites")
    aliases = aliases.withColumns(
        {c: F.col(c).try_cast("double") for c in ("Latitude", "Longitude", "stationDepth") if c in aliases.columns}
    )
    supplement = {c: "double" for c in ("Depth", *workbook.SUPPLEMENT_VALUES)}
    monthly = workbook.load(
        read("workbook", **{"Depth.m": "double"}),
        read("workbook_supplement", **supplement),
        aliases,
        lookups,
    )
    if values_2021 is None:
        names = read("coop_2021_limits").columns
        values_2021 = [c for c in names if c in read("coop_2021_chemistry").columns]
    others = [
        load_coastal(spark, paths, lookups, lakes),
        load_cooperative(spark, paths, lookups, values_2021),
        monthly,
        lab_ctd,
    ]
    result = ordered(finish(combine(lab, agency, others), lookups.flags))
    if out is not None:
        write_table(result, out, binary)
    return result
