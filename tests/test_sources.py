"""Each source contract on a handful of rows with the results written out."""

from __future__ import annotations

import datetime as dt

import pytest
from lookup_sheets import LAB_NAMES, lookups, name_rows
from pyspark.sql import functions as F

from obsharmony.operators import harmonize as hz
from obsharmony.sources import casts, coastal, cooperative, lab_database, workbook
from obsharmony.sources import standard as st

UTC = dt.datetime


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# --- lab database ------------------------------------------------------------------

LAB_FIXED = [
    "YEAR", "SEASON", "STATION_ID", "STN_DEPTH_M", "LATITUDE", "LONGITUDE", "SAMPLING_DATE", "TIME_ZONE",
    "SAMPLE_DEPTH_M", "DEPTH_CODE", "MEDIUM", "SAMPLE_TYPE", "QC_TYPE", "SAMPLE_ID", "Row",
]
LAB_GROUP = ["ANALYTE", "VALUE", "UNITS", "FRACTION", "METHOD", "RESULT_REMARK"]
LAB_SCHEMA = ", ".join(
    f"{c} string" for c in [*LAB_FIXED, *[f"{g}_{k}" for k in (1, 2) for g in LAB_GROUP]]
)
EMPTY = (None,) * 6


def lab_row(sample, first, second=EMPTY, **o):
    fixed = {
        "YEAR": "1999", "SEASON": "Spring", "STATION_ID": "MI11", "STN_DEPTH_M": "100", "LATITUDE": "42.5",
        "LONGITUDE": "-87", "SAMPLING_DATE": "1999/04/10 21:30", "TIME_ZONE": "EST", "SAMPLE_DEPTH_M": "5",
        "DEPTH_CODE": "Surface", "MEDIUM": "surface water", "SAMPLE_TYPE": "Individual",
        "QC_TYPE": "routine field sample", "SAMPLE_ID": sample, "Row": "1", **o,
    }
    return (*[fixed[c] for c in LAB_FIXED], *first, *second)


P = ("Total Phosphorus", "0.004", "mg/l", "Total", "M1", None)


@pytest.fixture(scope="module")
def lab(frame):
    rows = [
        lab_row("a", P, ("pH", "8.1", "none", None, "M1", None)),
        lab_row("b", ("Manganese", "<0.5", "none", "Total", None, "Less than Reporting Limit"),
                ("Manganese", "2", "ug/l", "Total", None, None)),
        lab_row("c", ("Silica, Dissolved as Si", "1.0", "mg/l", "Filtrate", "M1", None), TIME_ZONE="EDT"),
        lab_row("d", ("SRP", "0", "ug/l", "Filtrate", "M1", None), ("SRP", "-1", "ug/l", "Filtrate", "M1", "kept"),
                LATITUDE=None, LONGITUDE=None, STATION_ID="MI99", SEASON=None),
        lab_row("e", ("Old thing", "5", "ug/l", None, "M1", None), ("Nobody knows", "5", "ug/l", None, "M1", None)),
        lab_row("f", P, DEPTH_CODE="Integrated"),
        lab_row("g", P, QC_TYPE="duplicate"),
        lab_row("h", (P[0], "INV", *P[2:]), (P[0], "T", *P[2:])),
        lab_row("i", (P[0], None, *P[2:5], "remark only")),
        lab_row("j", P, LATITUDE="43.5", TIME_ZONE="???", STN_DEPTH_M=None),
    ]
    return frame(LAB_SCHEMA, rows)


def test_lab_read_keeps_only_usable_analyses(lab):
    long = lab_database.read(lab)
    assert sorted((r.SAMPLE_ID, r.ANALYTE, r.VALUE) for r in long.collect()) == [
        ("a", "Total Phosphorus", "0.004"), ("a", "pH", "8.1"),
        ("b", "Manganese", "2"), ("b", "Manganese", "<0.5"),
        ("c", "Silica, Dissolved as Si", "1.0"), ("d", "SRP", "-1"), ("d", "SRP", "0"),
        ("e", "Nobody knows", "5"), ("e", "Old thing", "5"), ("j", "Total Phosphorus", "0.004"),
    ]
    assert "Row" not in long.columns


def test_lab_read_by_sample(lab, frame):
    ids = frame("SAMPLE_ID string", [("c",)])
    assert [r.SAMPLE_ID for r in lab_database.read(lab, ids).collect()] == ["c"]


@pytest.fixture(scope="module")
def lab_parts(frame):
    names = frame("ANALYTE string, CodeName string", [("Total Phosphorus", "Tot_P"), ("Silica", "Diss_SiO2")])
    limits = frame(
        "`Survey (Units)` string, `Total Phosphorus (ug/l)` string, `Silica (mg Si/l)` string",
        [("Spring 1999", "3", "0.1"), ("Summer 1999", "0", "0.2")],
    )
    sites = frame("Station string, Latitude string, Longitude string", [("MI99", "44", "-86")])
    return lookups(frame, {"lab": LAB_NAMES}, names), sites, limits


def test_lab_clean(lab, lab_parts):
    look, sites, limits = lab_parts
    out = by(lab_database.clean(lab_database.read(lab), look, sites, limits), "UID", "ANALYTE", "RESULT")
    assert set(k[0] for k in out) == {"a", "b", "c", "d", "e", "j"}
    p = out["a", "Total Phosphorus", 4.0]
    assert (p.CodeName, p.ReportedUnits, p.TargetUnits, p.ConversionFactor) == ("Tot_P", "mgl", "ugl", 1000.0)
    assert (p.MDL, p.RL, p.LongName) == (3.0, None, "Phosphorus, unfiltered")
    assert p.sampleDateTime == UTC(1999, 4, 11, 2, 30) and p.sampleDate == dt.date(1999, 4, 11)
    assert out["a", "pH", 8.1].ReportedUnits == "unitless"
    # '<' result: no number, the limit of its season is known, the unit is the commonest one
    below = out["b", "Manganese", None]
    assert below.QAcomment == "Less than Reporting Limit; <0.5" and below.RL == 0.5
    assert below.ReportedUnits in ("ugl", "none")
    # the reporting limit reaches every manganese row of the season
    assert out["b", "Manganese", 2.0].RL == 0.5
    silica = out["c", "Silica, Dissolved as Si", 2.13918214]
    assert silica.sampleDateTime == UTC(1999, 4, 11, 1, 30)
    assert silica.MDL == pytest.approx(0.1 * 2.13918214)
    zero, negative = out["d", "SRP", 0.0], out["d", "SRP", -1.0]
    assert zero.QAcomment == "Method Detection Limit, less than" and negative.QAcomment == "kept"
    assert (zero.Latitude, zero.Longitude) == (44.0, -86.0)
    # removed names go, unknown names stay without a code
    assert ("e", "Old thing", 5.0) not in out and out["e", "Nobody knows", 5.0].CodeName is None
    odd = out["j", "Total Phosphorus", 4.0]
    assert odd.sampleDateTime is None and odd.stationDepth == 100.0


def test_lab_rejects_unmarked_less_than(frame, lab_parts):
    look, sites, limits = lab_parts
    bad = frame(LAB_SCHEMA, [lab_row("x", ("Manganese", "<1", "ug/l", "Total", None, "odd"))])
    with pytest.raises(ValueError, match="reporting limit"):
        lab_database.clean(lab_database.read(bad), look, sites, limits)


# --- coastal -----------------------------------------------------------------------

COASTAL = [
    *name_rows("NCCA_hydro_2010", [("Temperature", "Temp"), ("Corrected PAR", "CPAR"), ("Mean secchi", "Secchi"),
                                   ("Conductivity", "Cond"), ("Turbidity", "Remove"), ("pH", "pH")]),
    *name_rows("NCCA_hydro_2015", [("TEMPERATURE", "Temp"), ("Corrected PAR", "CPAR"), ("TRANS", "Remove"), ("DO", "DO")]),
    *name_rows("NCCA_secchi_2015", [("Secchi", "Secchi")]),
    ("NCCA_WChem_2010", "Total P", "PTL", None, None, None, "Tot_P", "x"),
    ("NCCA_WChem_2010", None, "CHLA", None, None, None, "Chla", "x"),
    *name_rows("NCCA_WChem_2015", [("Diss_NOx", "Diss_NOx"), ("CHLA", "Chla")]),
    *name_rows("NCCA_WChem_2020", [("Diss_NOx", "Diss_NOx"), ("CHLA", "Chla")]),
]


@pytest.fixture(scope="module")
def coast(frame):
    sites10 = coastal.sites_2010(frame(
        "SITE_ID string, ALAT_DD double, ALON_DD double, STATION_DEPTH double, WTBDY_NM string, NCCR_REG string",
        [("NCCAGL10-1", 43.0, -87.0, 12.0, "Lake Michigan", "Great Lakes"),
         ("NCCAGL10-1095", 43.5, -87.5, 9.0, "Lake Huron", "Great Lakes"),
         ("NCCA10-2", 30.0, -80.0, 3.0, "Sea", "Gulf"), ("NCCAGL10-3", None, -80.0, 3.0, "x", "Great Lakes")],
    ))
    site15 = ("UID double, SITE_ID string, LAT_DD83 double, LON_DD83 double, STATION_DEPTH double, GREAT_LAKE string")
    row = (1.0, "GLNS15-1340", 42.0, -86.0, 6.0, "Lake Michigan")
    sites15 = coastal.sites_2015(frame(site15, [row, row, (2.0, "S2", 42.1, -86.1, 20.0, "Lake Erie")]))
    return lookups(frame, {"coastal": COASTAL}), sites10, sites15


def test_sites_drop_incomplete_and_repeated(coast):
    assert sorted(r.SITE_ID for r in coast[1].collect()) == ["NCCAGL10-1", "NCCAGL10-1095"]
    assert coast[2].count() == 2


@pytest.fixture(scope="module")
def profiles10(frame, coast):
    schema = ("UID double, SITE_ID string, DATE_COL string, CAST string, SDEPTH double, `STATION_DEPTH(m)` double, "
              "PARAMETER string, PARAMETER_NAME string, RESULT double, UNITS string, QA_CODE string, QA_COMMENT string")
    a = (10.0, "NCCAGL10-1", "7/4/2010")
    rows = [
        (*a, "DOWNCAST", 1.0, 11.0, "t", "Temperature", 10.0, "C", None, None),
        (*a, "DOWNCAST", 1.0, 11.0, "t", "Temperature", 12.0, "C", "Q", "odd"),
        (*a, "UPCAST", 1.0, 11.0, "t", "Temperature", 99.0, "C", None, None),
        (*a, "DOWNCAST", 2.0, 11.5, "a", "Ambient PAR", 200.0, "uE", None, None),
        (*a, "DOWNCAST", 2.0, 11.5, "u", "Underwater PAR", 50.0, "uE", "A", None),
        (*a, "DOWNCAST", 3.0, 11.5, "a", "Ambient PAR", 0.0, "uE", None, None),
        (*a, "DOWNCAST", 3.0, 11.5, "u", "Underwater PAR", 5.0, "uE", None, None),
        (*a, "IM_CALC", -9.0, None, "s", "Mean secchi", -9.0, None, "X", None),
        (*a, "DOWNCAST", 4.0, 11.0, "b", "Turbidity", 4.0, None, None, None),
        (*a, "DOWNCAST", 4.0, 11.0, "c", "Conductivity", 300.0, "?S/cm", None, None),
        (11.0, "NCCAGL10-1095", "7/5/2010", "DOWNCAST", 1.0, 30.0, "p", "pH", 8.0, None, None, None),
        (12.0, "NCCA10-2", "7/5/2010", "DOWNCAST", 1.0, 30.0, "p", "pH", 8.0, None, None, None),
    ]
    return coastal.profile_2010(frame(schema, rows), coast[1], coast[0])


def test_profile_2010(profiles10):
    out = by(profiles10, "ANALYTE", "sampleDepth")
    assert set(out) == {("Temperature", 1.0), ("Corrected PAR", 2.0), ("Corrected PAR", 3.0), ("Mean secchi", None), ("Conductivity", 4.0), ("pH", 1.0)}
    # no surface light: infinitely many percent, which is a value
    assert out["Corrected PAR", 3.0].RESULT == float("inf")
    t = out["Temperature", 1.0]
    assert (t.RESULT, t.QAcode, t.QAcomment, t.stationDepth) == (11.0, "NA, Q", "NA, odd", 11.5)
    assert t.sampleDate == dt.date(2010, 7, 4) and t.WTBDY_NM == "Lake Michigan"
    light = out["Corrected PAR", 2.0]
    assert (light.RESULT, light.QAcode, light.ReportedUnits, light.CodeName) == (25.0, "NA, A", "percent", "CPAR")
    secchi = out["Mean secchi", None]
    assert (secchi.RESULT, secchi.ReportedUnits, secchi.stationDepth) == (None, "m", 11.5)
    assert out["Conductivity", 4.0].ReportedUnits == "uscm"
    # the site table's depth is the right one at this site
    assert out["pH", 1.0].stationDepth == 9.0


def test_profile_2015(frame, coast):
    schema = ("UID double, SITE_ID string, DATE_COL int, CAST string, DEPTH double, STATION_DEPTH double, TRANS double, "
              "CONDUCTIVITY double, DO double, PH double, TEMPERATURE double, LIGHT_AMB double, LIGHT_UW double, NARS_COMMENT string")
    rows = [
        (1.0, "GLNS15-1340", 42185, "DOWNCAST", 1.0, 5.0, 80.0, None, 9.0, None, 20.0, 0.0, 5.0, None),
        (2.0, "S2", 42185, "DOWNCAST", 2.0, 19.0, None, None, None, None, 18.0, 100.0, 120.0, "note"),
        (2.0, "S2", 42185, "UPCAST", 2.0, 19.0, None, None, None, None, 18.0, 100.0, 120.0, "note"),
    ]
    out = by(coastal.profile_2015(frame(schema, rows), coast[2], coast[0]), "UID", "ANALYTE")
    assert set(out) == {(1.0, "DO"), (1.0, "TEMPERATURE"), (2.0, "TEMPERATURE"), (2.0, "Corrected PAR")}
    assert out[2.0, "Corrected PAR"].RESULT == 120.0 and out[2.0, "Corrected PAR"].QAcomment == "note"
    assert out[1.0, "DO"].stationDepth == 6.0 and out[1.0, "DO"].sampleDate == dt.date(2015, 6, 30)


def test_secchi_2015(frame, coast):
    schema = ("UID double, SITE_ID string, VISIT_NO int, DATE_COL int, STATION_DEPTH double, MEAN_SECCHI_DEPTH double, "
              "DISAPPEARS double, REAPPEARS double, SECCHI_COMMENT string")
    rows = [
        (1.0, "GLNS15-1340", 1, 42167, 5.0, 9.0, 6.0, 7.0, None),
        (2.0, "S2", 1, 42167, 20.0, 9.0, 4.0, None, "fine"),
        (2.0, "S2", 2, 42168, 20.0, 9.0, None, None, None),
        (2.0, "S2", 3, 42169, 20.0, 9.0, 4.0, 4.0, "Data Missing for this site"),
    ]
    out = by(coastal.secchi_2015(frame(schema, rows), coast[2], coast[0]), "UID")
    assert set(out) == {1.0, 2.0}
    assert out[1.0].sampleDate == dt.date(2015, 6, 13) and out[2.0].sampleDate == dt.date(2015, 6, 12)
    assert (out[1.0].RESULT, out[1.0].QAcode, out[1.0].QAcomment) == (6.5, "CTB", "Secchi clear to bottom")
    assert (out[2.0].RESULT, out[2.0].QAcode, out[2.0].CodeName) == (4.0, None, "Secchi")


def test_chemistry_2010_and_combine(frame, coast, profiles10):
    schema = ("UID double, SITE_ID string, DATE_COL string, PARAMETER string, PARAMETER_NAME string, RESULT double, UNITS string, "
              "MDL double, MRL double, METHOD string, QACODE string")
    rows = [
        (10.0, "NCCAGL10-1", "07/04/2010", "PTL", "Total P", 0.005, "mg/L", 0.001, 0.01, None, "J"),
        (10.0, "NCCAGL10-1", "07/04/2010", "CHLA", None, 2.0, "ug/L", None, None, None, None),
        (10.0, "NCCAGL10-1", "07/04/2010", "ZZ", "Unknown", 2.0, "ug/L", None, None, None, None),
        (12.0, "NCCA10-2", "07/04/2010", "PTL", "Total P", 2.0, "ug/L", None, None, None, None),
    ]
    chem = coastal.chemistry_2010(frame(schema, rows), coast[0])
    out = by(chem, "CodeName")
    assert set(out) == {"Tot_P", "Chla"}
    p = out["Tot_P"]
    assert (p.RESULT, p.MDL, p.MRL, p.sampleDepth) == (5.0, 1.0, 10.0, 0.5)
    every = coastal.combine(profiles10, [], chem)
    assert every.count() == 8  # with the light under a dark surface
    lake = by(coastal.combine(profiles10, [], chem, ["Lake Michigan"]), "Study", "CodeName")
    assert ("NCCA_hydro_2010", "pH") not in lake
    got = lake["NCCA_WChem_2010", "Tot_P"]
    assert (got.UID, got.RL, got.stationDepth, got.Latitude) == ("NCCA-10", 10.0, 11.5, 43.0)


def test_chemistry_2015(frame, coast):
    schema = ("UID double, SITE_ID string, DATE_COL string, LAB string, ANALYTE string, LRL double, MDL double, METHOD string, "
              "RESULT double, RESULT_UNITS string, NARS_FLAG string, NARS_COMMENT string, SAMPLE_ID string")
    s, d = "S2", "30-JUN-2015"
    rows = [
        (2.0, s, d, "L", "NITRITE_N", None, 0.1, None, 1.0, "x", "NA;X;", None, "1"),
        (2.0, s, d, "L", "NITRATE_N", None, 0.2, None, 2.0, "x", "Y", "a;", "1"),
        (2.0, s, d, "L", "NITRATE_N", None, 0.2, None, 2.0, "x", None, None, "2"),
        (2.0, s, d, "L", "NITRITE_N", None, 0.1, None, None, "x", "ND", None, "3"),
        (2.0, s, d, "L", "NITRATE_N", None, 0.2, None, None, "x", "ND", None, "3"),
        (2.0, s, d, "L", "CHLA", 0.5, 0.1, None, 3.0, "x", "A,B", ": ", "1"),
        (2.0, s, d, "L", "OTHER", 0.5, 0.1, None, 3.0, "x", None, None, "1"),
    ]
    out = coastal.chemistry_2015(frame(schema, rows), coast[2], coast[0]).collect()
    nox = sorted((r.RESULT is None, r.RESULT, r.MDL) for r in out if r.CodeName == "Diss_NOx")
    assert [(r[1], pytest.approx(r[2])) for r in nox] == [(3000.0, 300.0), (None, 300.0)]
    chla = next(r for r in out if r.CodeName == "Chla")
    assert (chla.RESULT, chla.LRL, chla.QAcode, chla.QAcomment, chla.stationDepth) == (3.0, 0.5, "A,B", None, 20.0)
    assert len(out) == 3 and chla.sampleDate == dt.date(2015, 6, 30)


def test_chemistry_2020_prefers_reported_sum(frame, coast):
    schema = ("UID double, SITE_ID string, DATE_COL string, LAB string, ANALYTE string, RL double, MDL double, RESULT double, "
              "NARS_FLAG string, NARS_COMMENT string")
    rows = [
        (1.0, "a", "6/30/2020", "L", "NITRITE_N", None, 0.1, 1.0, None, None),
        (1.0, "a", "6/30/2020", "L", "NITRATE_N", None, 0.1, 2.0, None, None),
        (1.0, "a", "6/30/2020", "L", "NITRATE_NITRITE_N", 5.0, 0.3, 9.0, None, None),
        (1.0, "b", "6/30/2020", "L", "NITRITE_N", None, 0.1, 1.0, None, None),
        (1.0, "b", "6/30/2020", "L", "NITRATE_N", None, 0.1, 2.0, None, None),
    ]
    sites = frame("UID double, SITE_ID string, Latitude double, Longitude double", [(1.0, "a", 43.0, -87.0), (1.0, "b", 43.0, -87.0)])
    out = by(coastal.chemistry_2020(frame(schema, rows), sites, coast[0]), "SITE_ID")
    assert (out["a"].RESULT, out["a"].RL) == (9000.0, 5000.0) and out["b"].RESULT == 3000.0


# --- casts ---------------------------------------------------------------------------

CAST_NAMES = name_rows("SeaBird", [("temperature", "Temp"), ("cpar", "CPAR"), ("PAR", "Remove")])


def test_agency_casts(frame):
    schema = "STATION_ID string, sampleDateTime timestamp_ntz, sampleDepth double, stationDepth double, Latitude double, Longitude double, ANALYTE string, RESULT double, UNITS string"
    t = UTC(2010, 5, 1, 3)

    def row(path, depth, name, value, unit="C"):
        return (path, t, depth, None, 42.0, -87.0, name, value, unit)

    rows = [
        row("raw/700_MI11.cnv", 1.0, "temperature", 9.0), row("raw/700_MI11.cnv", 2.0, "cpar", 0.5, None),
        row("raw/701_MI18MA.bin", 7.0, "temperature", 8.0), row("raw/701_MI18MB.cnv", 7.0, "temperature", 8.0),
        row("raw/702_MI12 CAST2.cnv", 3.0, "temperature", 8.0), row("raw/703_MI,2.cnv", 3.0, "temperature", 8.0),
        row("raw/704_DERIVED.cnv", 3.0, "temperature", 8.0), row("raw/700_MI11.cnv", 9.0, "temperature", None),
        row("raw/700_MI11.cnv", 4.0, "PAR", 3.0), row("raw/cast_castle.cnv", 1.0, "temperature", 8.0),
    ]
    out = by(casts.agency_casts(frame(schema, rows), lookups(frame, {"casts": CAST_NAMES})), "UID")
    assert set(out) == {"SeaBird_MI11_2010-05-01_1", "SeaBird_MI11_2010-05-01_2", "SeaBird_MI18MA_2010-05-01_7", "SeaBird_MI12_2010-05-01_3"}
    light = out["SeaBird_MI11_2010-05-01_2"]
    assert (light.RESULT, light.ReportedUnits, light.maxCTDdepth, light.YEAR) == (50.0, "percent", 2.0, 2010.0)
    assert out["SeaBird_MI18MA_2010-05-01_7"].SITE_ID == "MI18M"


def test_lab_casts(frame):
    schema = ("ctdFiles string, SITE_ID string, sampleDateTime timestamp_ntz, sampleDateTime_ctd timestamp_ntz, Latitude double, "
              "Latitude_ctd double, Longitude double, Longitude_ctd double, stationDepth double, stationDepth_ctd double, sampleDepth double, "
              "ANALYTE string, RESULT double, UNITS string")
    swap, plain = UTC(2019, 12, 16), UTC(2010, 7, 19)

    def row(file, site, when, ctd=None, lat_ctd=None):
        return (file, site, when, ctd, 43.0, lat_ctd, -86.0, None, 20.0, None, 1.0, "temperature", 5.0, "C")

    rows = [
        row("x/M45.cnv", "beta", swap), row("x/M110.cnv", "omega", swap),
        row("y/M15d1730.cnv", "d1", plain), row("z/302_102913_0758_M110x.cnv", "omega", plain),
        row("w/a.cnv", "gamma", plain, UTC(1909, 7, 20, 4), 43.9),
    ]
    names = name_rows("NOAActd", [("temperature", "Temp")]) + name_rows("NOAA_WQ", [("temperature", "Secchi")])
    out = by(casts.lab_casts(frame(schema, rows), lookups(frame, {"workbook": names})), "SITE_ID")
    assert set(out) == {"omega", "beta", "alpha", "gamma"}
    assert out["omega"].stationDepth == 110.0 and out["beta"].stationDepth == 45.0
    assert out["alpha"].Latitude == 43.18816667
    g = out["gamma"]
    assert (g.Latitude, g.sampleDateTime, g.UID) == (43.9, UTC(2009, 7, 20, 4), "NOAActd_gamma_2009-07-20_1")


# --- workbook ------------------------------------------------------------------------


def test_workbook(frame):
    main = frame(
        "Year int, Month int, Day int, DOY int, Station string, `Depth.m` double, notes string, "
        "`SurfaceTemp.C` string, `Secchi.m` string, `TP.ugl` string, `PP.ugl` string",
        [
            (2010, 5, 1, 1, "Leg C1 no bag", 5.0, None, "10", "7..5", "4", "?"),
            (2010, 5, 1, 1, "Leg C1 no bag", 9.0, None, "10", "7..5", "0", "0.1"),
            (2010, 5, 2, 2, "M #110", 5.0, None, None, "on bottom", None, None),
            (2010, 5, 2, 2, "Musk", 5.0, None, "1", "1", "1", "1"),
        ],
    )
    extra = frame(
        "Year int, Month int, Day int, DOY int, Station string, Depth double, `SRP.ugl` double, `SiO2.mgl` double",
        [(2011, 6, 3, 1, "M110", 7.0, 1.5, None)],
    )
    aliases = frame(
        "`Other.names` string, SITE_ID string, Keep string, Justification string, Latitude double",
        [("c1", "c1", "T", None, 43.0), ("m110", "omega", "T", None, 43.2), ("musk", "musk", "F", None, 43.3)],
    )
    names = name_rows("NOAA_WQ", [("Secchi", "Secchi"), ("TP", "Tot_P"), ("SRP", "SRP"), ("SurfaceTemp", "Remove")])
    out = workbook.load(main, extra, aliases, lookups(frame, {"workbook": names}))
    got = {(r.SITE_ID, r.ANALYTE, r.sampleDepth): r for r in out.collect()}
    # zeros were never measured; an unknown name stays; a reading repeated over depths is kept once
    assert set(got) == {
        ("c1", "Secchi", None), ("c1", "TP", 5.0), ("c1", "PP", 9.0), ("omega", "Secchi", None), ("omega", "SRP", 7.0),
    }
    assert got["c1", "Secchi", None].RESULT == 7.5 and got["c1", "TP", 5.0].MDL == 0.2
    disc = got["omega", "Secchi", None]
    assert (disc.RESULT, disc.QAcode, disc.QAcomment, disc.UID) == (
        None, "CTB", "Secchi clear to bottom", "NOAA_WQ-omega-2010-5-2-NA",
    )
    assert got["omega", "SRP", 7.0].sampleDate == dt.date(2011, 6, 3)


# --- cooperative surveys ----------------------------------------------------------------

COOP = [
    *name_rows("CSMI_2015", [("NH4", "Diss_NHx"), ("Chla", "Chla"), ("Temptr", "Temp"), ("pH", "pH"), ("TSS", "Remove")]),
    *name_rows("CSMI_2021_WQ", [("NH4", "Diss_NHx"), ("ch.la", "Chla"), ("VSS", "remove")]),
    *name_rows("CSMI_2021_CTD", [("Temperature", "Temp"), ("cpar", "CPAR"), ("pH", "pH"), ("Temp_USGS", "Temp"), ("cpar_USGS", "CPAR"),
                                 ("Oxygen", "Remove"), ("SpecificConductance", "Remove"), ("PAR_USGS", "remove"), ("pH_USGS", "pH")]),
]


def test_cooperative_2015(frame):
    stations = frame("StationCodeKey string, `DepthM _target` double, LatDD_target double, LonDD_target double", [("Man_46", 46.0, 44.1, -87.5)])
    events = frame(
        "SampleEventKey string, StationCodeFK string, LatDD_actual double, LonDD_actual double, SampleDate timestamp_ntz, TimeEST timestamp_ntz, DepthM_actual double",
        [("Man_46_May", "Man_46", 46.11, -87.5, UTC(2015, 5, 1), UTC(1899, 12, 30, 21, 30), 46.0),
         ("Fra_46_May_LE2", "Fra_46", 44.0, -86.3, UTC(2015, 5, 2), UTC(1899, 12, 30, 9, 0), 47.0)],
    )
    layers = frame(
        "STISkey int, SampleEventFK string, WQdepth_m double, ASTlayername string",
        [(1, "Man_46_May", 5.0, "epi"), (2, "Man_46_May", 6.0, "hyp_cmp"), (5010, "wrong", 7.0, "hyp")],
    )
    limits = frame(
        "WQParam string, WQUnits string, DetectLimit string, Analyst string, AnalMethod string",
        [("NH4_x", "ugN/L", "2", "Ann", "M"), ("Temptr", "deg", "0.1", "Bob", "T"), ("DOC", "mg/L", "1", "C", "D")],
    )
    chem = frame("`STIS#` int, Chem_site string, NH4_ugNL double, Chla_ugL_lach double, TSS_mgL double", [(1, "M", 10.0, None, 1.0), (2, "M", 11.0, 1.0, None), (5010, "F", None, 3.0, None)])
    cast = frame("STISkey int, CTDdepth double, Temptr_C double, pH double", [(1, 4.5, 8.0, 8.2)])
    out = by(cooperative.load_2015(stations, events, layers, limits, chem, cast, lookups(frame, {"coop": COOP})), "UID", "CodeName")
    assert set(out) == {("CSMI-1", "Diss_NHx"), ("CSMI-1", "Temp"), ("CSMI-1", "pH"), ("CSMI-5010", "Chla")}
    nh4 = out["CSMI-1", "Diss_NHx"]
    assert (nh4.Latitude, nh4.MDL, nh4.LAB, nh4.METHOD, nh4.ConversionFactor, nh4.sampleDepth) == (44.1116833333333, 2.0, "Ann", "M", 1.0, 5.0)
    assert nh4.sampleDateTime == UTC(2015, 5, 2, 2, 30) and nh4.sampleDate == dt.date(2015, 5, 2)
    assert out["CSMI-1", "Temp"].sampleDepth == 4.5 and out["CSMI-1", "pH"].ReportedUnits == "unitless"
    assert out["CSMI-5010", "Chla"].SITE_ID == "Fra_46" and out["CSMI-5010", "Chla"].ReportedUnits == "ugl"


def test_cooperative_2021(frame):
    values = ["NH4.ug.N/L", "chl.a.ug/L", "VSS.mg/L"]
    chemistry = frame(
        "Site string, Date double, `Time.(EST)` string, `Site.Depth.(m)` double, `Separate.depths.(m)` double, `STIS#` int, "
        + ", ".join(f"`{v}` string" for v in values),
        [("EAS_10", 44377.0, "3:45 / 4:29", 10.0, 2.0, 7, "5", "1.5", "2"), ("PWA_20", 44377.0, "0.4375", 20.0, 3.0, 8, "-1", "2.5", None),
         ("STO5", 44377.0, "10:05 (CDT)", 30.0, 3.0, 9, "4", None, None), ("STO5", 44377.0, None, 30.0, 4.0, 10, "6", None, None)],
    )
    limits = frame("`NH4.ug.N/L` string, `chl.a.ug/L` string", [("0.5", "0.1")])
    agency = frame(
        "X2 string, X3 double, `Depth..fresh.water..m.` double, `Temperature..deg.C.` double, `Oxygen..mg.l.` double, "
        "`Specific.Conductance..uS.cm.` double, `CPAR.Corrected.Irradiance....` double, pH double, `Latitude..deg.` double, `Longitude..deg.` double",
        [("EAS_10", 44377.5, 1.0, 10.0, 9.0, 300.0, 80.0, 8.0, 44.0, -86.0), ("EAS_10", 44377.5, 2.0, 9.0, 9.0, 300.0, 60.0, 8.0, 44.2, -86.2),
         ("EAS_10", 44377.5, 3.0, 8.0, 9.0, 300.0, 50.0, 8.0, 12.0, 0.0), ("GTB_1", 44377.5, 4.0, 7.0, None, None, None, None, 45.0, -85.5)],
    )
    survey_sites = frame("TRANSECT string, BEG_LATITUDE_DD double, BEG_LONGITUDE_DD double, beg_depth double", [("LUD_5", 43.9, -86.5, 55.0)])
    survey = frame("Transect string, Serial string, Date string, Depth_m double, Temp_C double, PAR_uEinsteins_m2 double, pH double", [("LUD_5", "s1", "12-JUL-21", 1.0, 19.0, 5.0, 8.3)])
    light = frame(
        "Transect string, Date string, instrument_time double, Depth_m string, `dc.pc.PAR` double",
        [("LUD_5", "2021-07-12 00:00:00", 21.5, "0.5", 90.0), ("LUD_5", "2021-07-12 00:00:00", 21.6, "1.5", 50.0),
         ("LUD_5", "2021-07-12 00:00:00", 21.75, "2.5", 30.0), ("EAS_10", "2021-07-12 00:00:00", 10.0, "1", 30.0)],
    )
    frames = {"chemistry": chemistry, "limits": limits, "agency_casts": agency, "survey_casts": survey, "survey_sites": survey_sites, "light": light}
    out = by(cooperative.load_2021(frames, values, lookups(frame, {"coop": COOP})), "UID", "ANALYTE")
    nh4 = out["CSMI-CSMI_2021_WQ-7", "NH4"]
    assert nh4.sampleDateTime == UTC(2021, 6, 30, 9, 7) and (nh4.RESULT, nh4.MDL, nh4.SITE_ID) == (5.0, 0.5, "eas10")
    assert (nh4.Latitude, nh4.ReportedUnits) == (pytest.approx(44.1), "ug nl")
    assert out["CSMI-CSMI_2021_WQ-8", "chla"].SITE_ID == "pw20" and out["CSMI-CSMI_2021_WQ-8", "chla"].CodeName == "Chla"
    assert out["CSMI-CSMI_2021_WQ-8", "chla"].sampleDateTime == UTC(2021, 6, 30, 15, 30)
    assert ("CSMI-CSMI_2021_WQ-8", "NH4") not in out
    assert out["CSMI-CSMI_2021_WQ-9", "NH4"].sampleDateTime == UTC(2021, 6, 30, 15, 5)
    assert out["CSMI-CSMI_2021_WQ-10", "NH4"].sampleDate == dt.date(2021, 6, 30)
    ctd = out["CSMI-EPActd-eas10-3", "Temperature"]
    assert (ctd.Latitude, ctd.stationDepth, ctd.QAcode) == (pytest.approx(44.1), 10.0, None)
    gtb = out["CSMI-EPActd-gtb1-4", "Temperature"]
    assert (gtb.stationDepth, gtb.QAcode, gtb.ReportedUnits) == (4.0, "D", "c")
    usgs = out["CSMI-USGSctd-LUD_5_s1", "Temp_USGS"]
    assert (usgs.stationDepth, usgs.Latitude, usgs.sampleDate) == (55.0, 43.9, dt.date(2021, 7, 12))
    # half-metre depths go to the even metre; the surface bin is dropped
    par = out["CSMI-NBpar-lud5-2", "cpar_USGS"]
    assert (par.RESULT, par.sampleDateTime) == (40.0, UTC(2021, 7, 13, 2, 36))
    assert not [k for k in out if k[0].startswith("CSMI-NBpar-eas10")]
    assert out["CSMI-EPActd-gtb1-4", "Temperature"].CodeName == "Temp"


def test_number_text(frame):
    df = frame("x double", [(1.0,), (0.5,), (None,)])
    assert [r[0] for r in df.select(st.number_text("x")).collect()] == ["1", "0.5", None]


def test_standard_columns_coalesce_spellings(frame):
    df = frame("UID string, LRL double, MRL double, mdl double, STATION_ID string", [("u", None, 2.0, 1.0, "s")])
    row = st.as_observations(df).first()
    assert (row.RL, row.MDL, row.SITE_ID, row.RESULT) == (2.0, 1.0, "s", None)
    assert st.as_observations(df).select(F.col("sampleDateTime")).dtypes == [("sampleDateTime", "timestamp_ntz")]


def test_marked_values_of_agency_casts_are_missing(frame):
    names = [cooperative.AGENCY_SITE, cooperative.AGENCY_TIME, cooperative.AGENCY_DEPTH, *cooperative.AGENCY_VALUES, cooperative.AGENCY_LAT, cooperative.AGENCY_LON]
    schema = ", ".join(f"`{n}` {'string' if n == cooperative.AGENCY_SITE else 'double'}" for n in names)
    rows = [("EAS_1", 44377.5, 1.0, -9.99e-29, 9.0, 300.0, -9.99e-29, 8.0, 44.0, -86.0), ("EAS_1", 44377.5, 2.0, 7.0, 9.0, 300.0, 80.0, 8.0, 44.0, -86.0)]
    got = {(r.ANALYTE, r.sampleDepth): r.RESULT for r in cooperative.agency_casts_2021(frame(schema, rows)).collect()}
    assert got["Temperature", 1.0] is None and got["cpar", 1.0] is None and got["pH", 1.0] == 8.0
    assert got["Temperature", 2.0] == 7.0 and got["cpar", 2.0] == 80.0


def test_light_under_a_dark_surface_stays(frame):
    rows = [(s, a, v, "x", i) for i, (s, a, v) in enumerate([
        ("dark", "Ambient PAR", 0.0), ("dark", "Underwater PAR", 5.0), ("none", "Ambient PAR", 0.0), ("none", "Underwater PAR", 0.0),
        ("one", "Underwater PAR", 5.0), ("both", "Ambient PAR", 10.0), ("both", "Underwater PAR", 5.0)])]
    out = hz.surface_light_percent(frame("SITE_ID string, ANALYTE string, RESULT double, QAcode string, uid int", rows), ["SITE_ID"], "uid", texts=("QAcode",))
    assert {r.SITE_ID: r.RESULT for r in out.collect()} == {"dark": float("inf"), "both": 50.0}
