"""The whole job from files on disk to the written table."""

from __future__ import annotations

import csv
import datetime as dt

import pytest

from obsharmony.plans.assemble import FINAL, SORT, assemble
from obsharmony.sources.readers import (
    INPUTS, in_file_order, read_checked, read_lines, read_sheet_rows, read_table, write_checked, write_table,
)

NAME_HEADER = ["Study", "ANALYTE", "ANL_CODE", "Methods", "MEDIUM", "FRACTION", "CodeName", "Units"]


def names(study, *pairs):
    return [[study, a, "", "", "", "", c, "x"] for a, c in pairs]


SHEETS = {
    "naming_lab": [NAME_HEADER, ["GLENDA", "Total Phosphorus", "", "M1", "surface water", "Total", "Tot_P", "x"]],
    "naming_coastal": [
        NAME_HEADER,
        *names("NCCA_hydro_2010", ("Temperature", "Temp")), *names("NCCA_hydro_2015", ("TEMPERATURE", "Temp")),
        *names("NCCA_secchi_2015", ("Secchi", "Secchi")), *names("NCCA_WChem_2015", ("CHLA", "Chla")),
        ["NCCA_WChem_2010", "Total P", "PTL", "", "", "", "Tot_P", "x"],
    ],
    "naming_coop": [
        NAME_HEADER, *names("CSMI_2015", ("NH4", "Diss_NHx"), ("Temptr", "Temp")),
        *names("CSMI_2021_WQ", ("NH4", "Diss_NHx")),
        *names("CSMI_2021_CTD", ("Temperature", "Temp"), ("cpar", "CPAR"), ("Temp_USGS", "Temp"), ("cpar_USGS", "CPAR"),
               ("Oxygen", "Remove"), ("SpecificConductance", "Remove"), ("pH", "Remove")),
    ],
    "naming_workbook": [NAME_HEADER, *names("NOAA_WQ", ("Secchi", "Secchi"), ("TP", "Tot_P"), ("SRP", "SRP")), *names("NOAActd", ("temperature", "Temp"))],
    "naming_casts": [NAME_HEADER, *names("SeaBird", ("temperature", "Temp"), ("cpar", "CPAR"))],
    "key": [
        ["CodeName", "Units", "LongName", "Category", "Explicit_Units"],
        ["Tot_P", "ug/L", "Phosphorus, unfiltered", "Nutrients_Algae", "ug/L"], ["Temp", "C", "Temperature", "Chemical_Physical", "C"],
        ["CPAR", "percent", "PAR", "Chemical_Physical", "percent"], ["Secchi", "m", "Secchi", "Clarity_Carbon", "m"],
        ["Chla", "ug/L", "Chlorophyll-a", "Nutrients_Algae", "ug/L"], ["SRP", "ug/L", "SRP", "Nutrients_Algae", "ug/L"],
        ["Diss_NHx", "ug/L", "Ammonium", "Nutrients_Algae", "ug/L"],
    ],
    "conversions": [["ReportedUnits", "TargetUnits", "ConversionFactor"], ["mgl", "ugl", "1000"], ["mgl", "ugl", "1000"]],
    "limit_names": [["ANALYTE", "CodeName"], ["Total Phosphorus", "Tot_P"]],
    "flags": [
        ["flag_row", "Study", "QAcode", "QAcomment", "Definition", "Unified_Flag", "Unified_Comment", "Retain", "Action"],
        ["1", "GLENDA", "", "MDL", "below MDL", "N", "Below Method Detection Limit", "Keep", ""],
        ["2", "SeaBird", "D", "", "depth", "D", "Station depth estimated", "Keep", ""],
        ["3", "NOAA_WQ", "CTB", "", "clear", "B", "Secchi clear to bottom", "Keep", ""],
        ["4", "NCCA_WChem_2010", "J", "", "bad", "", "", "Remove", ""],
    ],
    "coastal_profile_2010": [
        ["UID", "SITE_ID", "DATE_COL", "CAST", "SDEPTH", "STATION_DEPTH(m)", "PARAMETER", "PARAMETER_NAME", "RESULT", "UNITS", "QA_CODE", "QA_COMMENT"],
        ["10", "NCCAGL10-1", "7/4/2010", "DOWNCAST", "1", "11", "t", "Temperature", "10.5", "C", "", ""],
        ["11", "NCCAGL10-2", "7/4/2010", "DOWNCAST", "1", "11", "t", "Temperature", "10.5", "C", "", ""],
    ],
    "coastal_sites_2010": [
        ["SITE_ID", "ALAT_DD", "ALON_DD", "STATION_DEPTH", "WTBDY_NM", "NCCR_REG"],
        ["NCCAGL10-1", "43", "-87", "12", "Lake Michigan", "Great Lakes"], ["NCCAGL10-2", "44", "-82", "12", "Lake Huron", "Great Lakes"],
    ],
    "coastal_chemistry_2010": [
        ["UID", "SITE_ID", "DATE_COL", "PARAMETER", "PARAMETER_NAME", "RESULT", "UNITS", "MDL", "MRL", "PQL", "METHOD", "QACODE", "STATE"],
        ["10", "NCCAGL10-1", "07/04/2010", "PTL", "Total P", "0.005", "mg/L", "0.001", "0.01", "", "", "", "WI"],
        ["10", "NCCAGL10-1", "07/05/2010", "PTL", "Total P", "0.006", "mg/L", "0.001", "0.01", "", "", "J", "WI"],
    ],
    "coastal_sites_2015": [["UID", "SITE_ID", "LAT_DD83", "LON_DD83", "STATION_DEPTH", "GREAT_LAKE"], ["20", "S1", "42", "-86", "6", "Lake Michigan"]],
    "coastal_profile_2015": [
        ["UID", "SITE_ID", "DATE_COL", "CAST", "DEPTH", "STATION_DEPTH", "TRANS", "CONDUCTIVITY", "DO", "PH", "TEMPERATURE", "LIGHT_AMB", "LIGHT_UW", "NARS_COMMENT"],
        ["20", "S1", "42185", "DOWNCAST", "1", "5", "", "", "", "", "20", "0", "5", ""],
    ],
    "coastal_secchi_2015": [
        ["UID", "SITE_ID", "VISIT_NO", "DATE_COL", "STATION_DEPTH", "MEAN_SECCHI_DEPTH", "DISAPPEARS", "REAPPEARS", "SECCHI_COMMENT"],
        ["20", "S1", "1", "42167", "5", "9", "3", "4", ""],
    ],
    "coastal_chemistry_2015": [
        ["UID", "SITE_ID", "DATE_COL", "LAB", "ANALYTE", "LRL", "MDL", "METHOD", "RESULT", "RESULT_UNITS", "NARS_FLAG", "NARS_COMMENT", "SAMPLE_ID", "BATCH_ID"],
        ["20", "S1", "30-JUN-2015", "L", "CHLA", "", "0.1", "", "3", "ug/L", "", "", "1", "1"],
    ],
    "lab_database": [
        ["YEAR", "SEASON", "STATION_ID", "STN_DEPTH_M", "LATITUDE", "LONGITUDE", "SAMPLING_DATE", "TIME_ZONE", "SAMPLE_DEPTH_M", "DEPTH_CODE",
         "MEDIUM", "SAMPLE_TYPE", "QC_TYPE", "SAMPLE_ID", "Row", "ANALYTE_1", "VALUE_1", "UNITS_1", "FRACTION_1", "METHOD_1", "RESULT_REMARK_1"],
        *[["1999", "Spring", "MI11", "100", "42.5", "-87", "1999/04/10 21:30", "EST", "5", "Surface", "surface water", "Individual",
           "routine field sample", sample, "1", "Total Phosphorus", value, "mg/l", "Total", "M1", ""] for sample, value in (("a", "0.001"), ("b", "0.009"), ("b", "0.009"))],
    ],
    "lab_limits": [["Survey (Units)", "Total Phosphorus (ug/l)"], ["Spring 1999", "3"]],
    "lab_sites": [["Station", "Latitude", "Longitude"], ["MI99", "44", "-86"]],
    "coop_2015_stations": [["StationCodeKey", "DepthM _target", "LatDD_target", "LonDD_target"], ["Man_46", "46", "44.1", "-87.5"]],
    "coop_2015_events": [
        ["SampleEventKey", "StationCodeFK", "LatDD_actual", "LonDD_actual", "SampleDate", "TimeEST", "DepthM_actual"],
        ["e1", "Man_46", "44.1", "-87.5", "2015-05-01 00:00:00", "1899-12-30 21:30:00", "46"],
    ],
    "coop_2015_layers": [["STISkey", "SampleEventFK", "WQdepth_m", "ASTlayername"], ["1", "e1", "5", "epi"]],
    "coop_2015_limits": [["WQParam", "WQUnits", "DetectLimit", "Analyst", "AnalMethod"], ["NH4", "ugN/L", "2", "Ann", "M"]],
    "coop_2015_chemistry": [["STIS#", "Chem_site", "NH4_ugNL"], ["1", "M", "10"]],
    "coop_2015_casts": [["STISkey", "CTDdepth", "Temptr_C"], ["1", "4.5", "8"]],
    "coop_2021_chemistry": [["Site", "Date", "Time.(EST)", "Site.Depth.(m)", "Separate.depths.(m)", "STIS#", "NH4.ug.N/L"], ["EAS_10", "44377", "10:05 (CDT)", "10", "2", "7", "5"]],
    "coop_2021_limits": [["NH4.ug.N/L"], ["0.5"]],
    "coop_2021_agency_casts": [
        ["X2", "X3", "Depth..fresh.water..m.", "Temperature..deg.C.", "Oxygen..mg.l.", "Specific.Conductance..uS.cm.", "CPAR.Corrected.Irradiance....", "pH", "Latitude..deg.", "Longitude..deg."],
        ["EAS_10", "44377.5", "1", "10", "9", "300", "80", "8", "44", "-86"],
    ],
    "coop_2021_survey_casts": [["Transect", "Serial", "Date", "Depth_m", "Temp_C"], ["LUD_5", "s1", "12-JUL-21", "1", "19"]],
    "coop_2021_survey_sites": [["TRANSECT", "BEG_LATITUDE_DD", "BEG_LONGITUDE_DD", "beg_depth"], ["LUD_5", "43.9", "-86.5", "55"]],
    "coop_2021_light": [["Transect", "Date", "instrument_time", "Depth_m", "dc.pc.PAR"], ["LUD_5", "2021-07-12 00:00:00", "9.5", "1.2", "50"]],
    "workbook": [["Year", "Month", "Day", "DOY", "Station", "Depth.m", "CTD.#", "notes", "Secchi.m", "TP.ugl", "PP.ugl"], ["2010", "5", "1", "121", "M 110", "5", "1", "", "on bottom", "4", "?"]],
    "workbook_supplement": [["Year", "Month", "Day", "DOY", "Station", "Depth", "SRP.ugl", "SiO2.mgl"], ["2010", "5", "1", "121", "M110", "5", "1.5", ""]],
    "workbook_sites": [["Other.names", "SITE_ID", "Keep", "Justification", "Latitude", "Longitude", "stationDepth"], ["m110", "omega", "T", "", "43.2", "-86.5", "110"]],
}
TIME = "timestamp_ntz"
CASTS = "STATION_ID string, sampleDateTime timestamp_ntz, sampleDepth double, stationDepth double, Latitude double, Longitude double, ANALYTE string, RESULT double, UNITS string"
LAB_CASTS = (
    "ctdFiles string, SITE_ID string, sampleDateTime timestamp_ntz, sampleDateTime_ctd timestamp_ntz, Latitude double, Latitude_ctd double, Longitude double, "
    "Longitude_ctd double, stationDepth double, stationDepth_ctd double, sampleDepth double, ANALYTE string, RESULT double, UNITS string"
)


@pytest.fixture(scope="module")
def catalog(frame, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    paths = {}
    for name, rows in SHEETS.items():
        paths[name] = str(root / f"{name}.csv")
        with open(paths[name], "w", newline="") as f:
            csv.writer(f).writerows(rows)
    t = dt.datetime(1999, 5, 1, 3)
    agency = [("x/1_MI11.cnv", t, 3.0, None, 42.5, -87.0, "temperature", 5.0, "C"), ("x/2_MIC.cnv", t, 17.0, None, 42.0, -87.0, "cpar", 1.5, None)]
    lab = [("x/M110.cnv", "omega", t, None, 43.0, None, -86.0, None, 110.0, None, 1.0, "temperature", 5.0, "C")] * 2
    for name, schema, rows in (("agency_casts", CASTS, agency), ("lab_casts", LAB_CASTS, lab)):
        paths[name] = write_table(frame(schema, rows), str(root / name))
    assert sorted(paths) == sorted(INPUTS)
    return paths


@pytest.fixture(scope="module")
def result(spark, catalog, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "all")
    df = assemble(spark, catalog, out=out, lakes=["Lake Michigan"])
    return df, out, df.collect()


def test_columns_and_sources(result):
    df, _, rows = result
    assert df.columns == FINAL
    assert {r.Study for r in rows} == {
        "GLENDA", "SeaBird", "NOAActd", "NOAA_WQ", "NCCA_hydro_2010", "NCCA_hydro_2015", "NCCA_secchi_2015", "NCCA_WChem_2010",
        "NCCA_WChem_2015", "CSMI_2015", "CSMI_2021_WQ", "CSMI_2021_CTD",
    }
    assert all(r.UID and r.SITE_ID and r.sampleDate for r in rows)


def test_rows(result):
    rows = {}
    for r in result[2]:
        assert (r.UID, r.CodeName) not in rows, "repeated source rows are kept once"
        rows[r.UID, r.CodeName] = r
    low, high = rows["a", "Tot_P"], rows["b", "Tot_P"]
    # below the limit: censored, flagged, with the limit beside it; local date differs from the UTC date
    assert (low.RESULT, low.Unified_Flag, low.MDL, low.Orig_QAcode) == (None, "N", 3.0, "MDL")
    assert (high.RESULT, high.Unified_Flag, high.Units, high.ReportedUnits) == (9.0, None, "ug/L", "mgl")
    assert high.sampleDateTimeUTC == dt.datetime(1999, 4, 11, 2, 30) and high.sampleDate == dt.date(1999, 4, 10)
    cast = rows["SeaBird_MI11_1999-05-01_3", "Temp"]
    assert (cast.stationDepth, cast.Unified_Flag, cast.sampleDate) == (100.0, None, dt.date(1999, 4, 30))
    light = rows["SeaBird_MIC_1999-05-01_17", "CPAR"]
    assert (light.stationDepth, light.RESULT, light.Unified_Flag) == (17.0, 150.0, "D")
    assert light.Orig_QAcode == "D; PAR"
    secchi = rows["NOAA_WQ-omega-2010-5-1-NA", "Secchi"]
    assert (secchi.RESULT, secchi.Unified_Flag) == (None, "B")
    # removed by the flag table; another lake
    assert not [r for r in result[2] if r.Study == "NCCA_WChem_2010" and r.Orig_QAcode and "J" in r.Orig_QAcode]
    assert ("NCCA-11", "Temp") not in rows
    assert rows["CSMI-1", "Diss_NHx"].LAB == "Ann"


def test_sorted_with_missing_last(result):
    def key(r):
        return [(r[c] is None, r[c] if r[c] is not None else 0) for c in [*SORT, "UID"]]

    keys = [[(m, str(v)) if not isinstance(v, float) else (m, f"{v:09.3f}") for m, v in key(r)] for r in result[2]]
    assert keys == sorted(keys)


def test_written_table_equals_result(spark, result):
    df, out, rows = result
    back = spark.read.parquet(f"{out}.parquet")
    assert back.columns == FINAL and back.count() == len(rows)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows))


def test_csv_sink(spark, catalog, result, tmp_path):
    target = write_table(result[0].select("UID", "RESULT"), str(tmp_path / "t"), binary=False)
    back = read_table(spark, f"{tmp_path}/t.csv", {"RESULT": "double"})
    assert target.endswith("t.csv") and back.dtypes == [("RESULT", "double")] and back.count() == len(result[2])
    marked = read_table(spark, catalog["coop_2021_agency_casts"], {"pH": "double"}, null_values=("8",))
    assert [r.pH for r in marked.collect()].count(None) == 1
    two = read_table(spark, [catalog["key"], catalog["key"]])
    assert two.count() == 14
    assert [r.row_no for r in in_file_order(read_table(spark, catalog["key"])).collect()] == list(range(7))
    with pytest.raises(ValueError, match="no column"):
        read_table(spark, catalog["key"], {"absent": "string"})



def test_manifest_tells_what_was_written(frame, tmp_path, spark):
    rows = [(1, "a, \"b\"", 1.5), (2, None, None), (2, None, None), (3, "é", -0.0)]
    df = frame("k bigint, t string, x double", rows)
    kinds = {"k": "bigint", "t": "string", "x": "double"}
    for binary in (True, False):
        target = write_checked(df, str(tmp_path / f"t{binary}"), binary)
        back = read_checked(spark, target, kinds)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        df.limit(1).write.mode("append").option("header", True).option("escape", '"').format("parquet" if binary else "csv").save(target)
        with pytest.raises(ValueError, match="manifest"):
            read_checked(spark, target, kinds)
    none = write_checked(df.filter("k > 9"), str(tmp_path / "none"))
    assert read_checked(spark, none).count() == 0


def test_filters_reach_the_scan_of_typed_columns(frame, tmp_path, spark):
    target = write_table(frame("k bigint, x double, unread string", [(1, 2.0, "a"), (2, 3.0, "b")]), str(tmp_path / "p"))
    df = read_table(spark, target, {"k": "bigint", "x": "double"}).filter("x > 2.5")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,2.5)" in text and "unread" not in text and [tuple(r) for r in df.collect()] == [(2, 3.0)]


def test_lines_of_many_blocks_are_numbered_in_file_order(tmp_path, spark):
    text = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_text("\n".join(text) + "\n")
    (tmp_path / "two.txt").write_text("only")
    (tmp_path / "empty.txt").write_text("")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = {(r.path.rsplit("/", 1)[1], r.line_no): r.line for r in read_lines(spark, str(tmp_path), "*.txt").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert got == {("one.txt", i + 1): x for i, x in enumerate(text)} | {("two.txt", 1): "only"}


def test_sheet_rows_by_header_and_range(tmp_path, spark):
    (tmp_path / "s.csv").write_text('k,name,v\n' + "\n".join(f'{i},"n, ""{i}""",{"NA" if i == 4 else i / 2}' for i in range(1, 8)))
    (tmp_path / "r.csv").write_text("v,k\n9,1\n8,x")
    kinds = {"k": "bigint", "name": "string", "v": "double"}
    got = sorted(((r.sheet[-5:], r.row_no), (r.k, r.name, r.v)) for r in read_sheet_rows(spark, str(tmp_path), kinds, 2, 4).collect())
    assert got == [(("r.csv", 2), (None, None, 8.0)), *((("s.csv", i), (i, f'n, "{i}"', None if i == 4 else i / 2)) for i in (2, 3, 4))]
