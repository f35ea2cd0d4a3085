"""Instrument text files to the binned cast table, and file names to site and date."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from obsharmony.operators import profiles
from obsharmony.sources import cast_files
from obsharmony.sources.readers import read_lines

HEADER = """* Sea-Bird data file
* NMEA Latitude = 43 12.00 N
* NMEA Longitude = 086 30.00 W
# name 0 = depSM: Depth [salt water, m]
# name 1 = t090C: Temperature [deg C]
# name 2 = par: PAR
# name 3 = spar: SPAR
# name 4 = t190C: Temperature, 2 [deg C]
# start_time = Jul 19 2010 17:30:00
*END*
"""
SCANS = [
    (0.05, 20.0, 90, 100), (0.6, 19.0, 80, 100), (1.4, 18.0, 70, 100), (1.6, 17.0, 60, 0), (2.4, 16.0, 50, 100),
    (3.0, 15.0, 40, 100), (2.0, 99.0, 1, 1),
]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("casts")
    (root / "deep").mkdir()
    body = "\n".join(f"  {d}  {t} {p} {s} 7.0" for d, t, p, s in SCANS)
    (root / "deep" / "good.cnv").write_text(HEADER + body + "\n")
    (root / "nohead.cnv").write_text("* Sea-Bird\n1 2 3\n")
    (root / "nodepth.cnv").write_text("# name 0 = t090C: Temperature\n# date = 2011-05-06\n*END*\n5\n")
    (root / "skipped.txt").write_text("nothing")
    return read_lines(spark, str(root))


def test_line_numbers_follow_the_file(lines):
    rows = [r for r in lines.orderBy("line_no").collect() if r.path.endswith("good.cnv")]
    assert [r.line.split()[0] for r in rows[:2]] == ["*", "*"] and rows[-1].line.split()[1] == "99.0"
    assert len({r.line_no for r in rows}) == len(rows) == 17


def test_headers_and_census(lines):
    head = cast_files.headers(lines)
    got = {r.path.rsplit("/", 1)[1]: r for r in head.collect()}
    good = got["good.cnv"]
    assert good.names == ["depsm", "t090c", "par", "spar", "t190c"]
    assert good.sampleDateTime == dt.datetime(2010, 7, 19, 17, 30)
    assert (good.Latitude, good.Longitude, good.stationDepth) == (43.2, -86.5, None)
    assert got["nodepth.cnv"].sampleDateTime == dt.datetime(2011, 5, 6)
    census = {r.name: r.files for r in cast_files.name_census(head).collect()}
    assert census["t090c"] == 2 and census["spar"] == 1


def test_bad_files_are_listed_not_raised(lines):
    errors = cast_files.file_errors(lines, cast_files.headers(lines))
    got = {r.path.rsplit("/", 1)[1]: r.reason for r in errors.collect()}
    assert got == {"nohead.cnv": "no end of header", "nodepth.cnv": "no depth column"}


def test_cast_table(lines):
    table = cast_files.cast_table(lines, despike_spread=100.0)
    got = {(r.ANALYTE, r.sampleDepth): r for r in table.collect()}
    assert {k: r.RESULT for k, r in got.items() if k[0] == "temperature"} == {
        ("temperature", 1.0): 18.5, ("temperature", 2.0): 16.5, ("temperature", 3.0): 15.0,
    }
    # no surface light at one scan: its ratio is unknown, not infinite
    assert got["cpar", 2.0].RESULT == 0.5 and got["cpar", 1.0].RESULT == 0.75
    assert got["temperature", 1.0].UNITS == "C" and got["cpar", 1.0].UNITS is None
    assert got["temperature", 1.0].Latitude == 43.2


def test_despike_long_cast_in_chunks(frame, monkeypatch):
    monkeypatch.setattr(profiles, "_CHUNK", 8)
    values = [float(i % 5) for i in range(50)]
    values[7], values[16], values[40] = 500.0, None, -400.0
    df = frame("cast string, scan int, x double", [("a", i * 3, v) for i, v in enumerate(values)])
    got = [r.x for r in profiles.despike(df, ["cast"], "scan", ["x"]).orderBy("scan").collect()]

    import statistics

    def ref(i):
        near = [v for v in values[max(0, i - 3) : i + 4] if v is not None]
        return statistics.median(near)

    gaps = [v - ref(i) for i, v in enumerate(values) if v is not None]
    sd = statistics.stdev(gaps)
    want = [
        None if v is None else (ref(i) if abs(v - ref(i)) > 4 * sd else v) for i, v in enumerate(values)
    ]
    assert got == want and got[7] != 500.0 and got[40] != -400.0 and got[16] is None


PATHS = [
    ("2010/200-10 lau/Raw/M45_1.cnv", "m45", dt.date(2010, 7, 19)),
    ("2010/trip/7-19-10/Alpha.CNV", "alpha", dt.date(2010, 7, 19)),
    ("2010/trip/x/stationb_7_19_10.cnv", "stationb", dt.date(2010, 7, 19)),
    ("2010/trip/June 5-11 omega.cnv", "omega", dt.date(2011, 6, 5)),
    ("2010/trip/cnv/200_10/gh12.bin", "gh12", dt.date(2010, 7, 19)),
    ("2010/trip/cnv/ds-7.cnv", "ds-7", None),
    ("2010/trip/x/hope3_366-11.cnv", "hope3", None),
    ("2010/unknown/nothing/zzz.cnv", None, None),
]


def test_path_site_and_date(frame):
    df = frame("path string, i int", [(p, i) for i, (p, _, _) in enumerate(PATHS)])
    rows = (
        profiles.with_path_date(df, "path")
        .withColumn("site", profiles.path_site("path"))
        .orderBy("i")
        .collect()
    )
    assert [(r.site, r.sampleDate) for r in rows] == [(s, d) for _, s, d in PATHS]


def test_file_sites_keeps_listed_sites(frame):
    paths = frame("ctdFiles string", [("2010/trip/7-19-10/Alpha.CNV",), ("2010/trip/7-19-10/musk.cnv",)])
    aliases = frame("`Other.names` string, SITE_ID string, Keep string, Justification string", [("alpha", "alpha", "T", None), ("musk", "m", "F", "no")])
    got = cast_files.file_sites(paths, "ctdFiles", aliases).collect()
    assert [(r.SITE_ID, r.sampleDate) for r in got] == [("alpha", dt.date(2010, 7, 19))]


def test_cast_query_takes_spikes_out(spark):
    """The registered SQL leaves the despike step out; this one has it."""
    duck = duckdb.connect()
    duck.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.01/events.parquet'")
    rows = """WITH s AS (SELECT 'casts/' || user_id || '.cnv' AS path, event_id AS scan, CAST((event_id * 7) % 41 AS DOUBLE) / 2 AS depth, value AS t FROM events),
      turn AS (SELECT path, min(scan) AS turn FROM (SELECT *, max(depth) OVER (PARTITION BY path) AS deepest FROM s) WHERE depth = deepest GROUP BY ALL),
      r AS (SELECT s.*, median(t) OVER (PARTITION BY path ORDER BY scan ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS ref FROM s JOIN turn USING (path) WHERE scan <= turn),
      sd AS (SELECT path, stddev_samp(t - ref) AS sd FROM r GROUP BY ALL)
      SELECT path, CAST(floor(depth - 5e-1) + 1 AS DOUBLE) AS bin, avg(t) AS plain, avg(CASE WHEN abs(t - ref) > 4 * sd THEN ref ELSE t END) AS clean
      FROM r JOIN sd USING (path) WHERE depth >= 5e-1 GROUP BY ALL"""
    want = {(p, d): (plain, clean) for p, d, plain, clean in duck.execute(rows).fetchall()}
    out = entry.queries()["source_cast_text"](spark, "/root/testdata/sf0.01").where("ANALYTE = 'temperature'")
    got = {(r.STATION_ID, r.sampleDepth): r.RESULT for r in out.collect()}
    assert got.keys() == want.keys() and any(abs(a - b) > 1e-3 for a, b in want.values())
    assert all(got[k] == pytest.approx(clean, rel=1e-5, abs=1e-5) for k, (_, clean) in want.items())
