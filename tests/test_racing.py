"""The racing tables end to end from small CSV files: landing, gate, marts, audits."""

import pytest
from helpers import RUN_TS
from pyspark.sql import functions as F

from sluiceworks.operators import audit
from sluiceworks.operators.gate import reason_counts
from sluiceworks.plans import racing
from sluiceworks.plans.flow import build, land
from sluiceworks.sources import landed_files

N = "\\N"
FILES = {
    "seasons": [(1954, "u"), (2008, "u"), (2026, "u")],
    "status": [(1, "Finished"), (5, "Engine")],
    "circuits": [
        (1, "alba", "Alba", "Alba", "Italy", "44.7", "8.0", "172", "u"),
        (2, "boa", 'The "Boa", new', "Boa", "Spain", "40.0", "-3.0", N, "u"),
        (3, "cima", "Cima", "Cima", "Peru", "-12.0", "-77.0", N, "u"),
        (4, "dora", "Dora", "Dora", "Mars", "91.0", "0.0", N, "u"),
    ],
    "constructors": [(1, "ant", "Ant", "Italian", "u"), (2, "bee", "Bee", "Dutch", "u")],
    "drivers": [
        (1, "ada", "44", "ADA", "Ada", "Lane", "1985-01-07", "British", "u"),
        (2, "bo", N, N, "Bo", "Moss", "1929-09-17", "British", "u"),
        (3, "bo2", N, N, "Bo", "Moss", "1930-09-17", "Irish", "u"),
        (4, "late", N, N, "Late", "Born", "2015-01-01", "Irish", "u"),
    ],
    "races": [
        (1, 1954, 1, 1, "Alba GP", "1954-07-17") + (N,) * 12,
        (2, 2008, 1, 1, "Alba GP", "2008-03-16") + (N,) * 12,
        (3, 2008, 2, 2, "Boa GP", "2008-04-16") + (N,) * 12,
        (4, 2026, 1, 3, "Cima GP", "2026-12-06") + (N,) * 12,
        (5, 2008, 3, 4, "Dora GP", "2008-05-16") + (N,) * 12,
    ],
    "results": [
        # id race driver team number grid position text order points laps time ms fastest rank time speed status
        (1, 2, 1, 1, 22, 1, 1, "1", 1, 10, 58, "1:34:50.616", 5690616, 39, 2, "1:27.452", "218.3", 1),
        (2, 2, 2, 2, 7, 2, N, "R", 2, 0, 12, N, N, N, N, N, N, 5),
        (3, 3, 1, 1, 22, 3, 2, "2", 2, 8, 58, N, N, N, N, N, N, 1),
        (4, 3, 2, 1, 23, 1, 1, "1", 1, 10, 58, N, N, N, N, N, N, 1),
        (5, 1, 2, 2, N, 1, 1, "1", 1, "8.142857", 90, N, N, N, N, N, N, 1),
        (6, 1, 3, 2, N, 4, 2, "2", 2, "6.142857", 90, N, N, N, N, N, N, 1),
        (7, 5, 1, 1, 22, 1, 1, "1", 1, 10, 58, N, N, N, N, N, N, 1),  # race of a wrong circuit
        (8, 3, 4, 2, 9, 1, 3, "3", 3, 6, 58, N, N, N, N, N, N, 1),  # driver born too late
    ],
    "sprint_results": [
        (1, 4, 1, 1, 22, 1, N, "N", 1, 0, 0, N, N, N, N, N, N),  # no status yet
    ],
    "qualifying": [(1, 2, 1, 1, 22, 1, "1:26.572", "1:25.187", "1:26.714"), (2, 2, 2, 2, 7, 0, N, N, N)],
    "lap_times": [
        (2, 1, 1, 1, "1:27.1", 87100), (2, 1, 2, 1, "1:27.2", 87200), (2, 1, 2, 1, "1:27.2", 87200),
        (2, 1, 3, 1, "1:27.3", 87300), (2, 1, 3, 1, "1:27.3", 87301),
    ],
    "pit_stops": [
        (2, 1, 1, 10, "17:05:23", "26.898", 26898), (2, 1, 2, 20, "17:25:23", "1:02.1", 62100),
        (2, 2, 1, 11, "17:06:23", "25.0", 25000), (3, 1, 1, 9, "15:00:00", N, N),
    ],
    "driver_standings": [(1, 2, 1, 10, 1, "1", 1), (2, 2, 2, -1, 2, "2", 0)],
    "constructor_standings": [(1, 2, 1, 10, 1, "1", 1)],
    "constructor_results": [(1, 2, 1, 10, N), (2, 9, 1, 10, "D")],
}


def write_csv(folder, name, header, rows):
    def cell(v):
        text = str(v)
        return '"' + text.replace('"', '""') + '"' if isinstance(v, str) and v != N else text

    lines = [",".join(header), *[",".join(map(cell, r)) for r in rows]]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name, rows in FILES.items():
        write_csv(folder, name, [c.source for c in racing.CONTRACTS[name].columns], rows)
    return folder


@pytest.fixture(scope="module")
def raw(spark, landing):
    return land(spark, str(landing), racing.CONTRACTS, RUN_TS)


@pytest.fixture(scope="module")
def built(spark, raw):
    return build(spark, raw, racing.CONTRACTS)


@pytest.fixture(scope="module")
def marts(built):
    return racing.marts({n: b.trusted for n, b in built.items()})


def test_landing_keeps_every_value(spark, raw):
    row = raw["circuits"].where("circuitId = '2'").first()
    assert (row.name, row.alt) == ('The "Boa", new', N)
    assert row._source_file == "circuits.csv" and row._ingested_at == RUN_TS
    counts = audit.observed_counts(raw)
    manifest = spark.createDataFrame([(n, len(r)) for n, r in FILES.items()], "dataset string, expected_rows bigint")
    audit.require(audit.completeness(counts, manifest), "rows_ok AND header_ok", "landing")


def test_missing_file_stops_the_landing(spark, tmp_path):
    write_csv(tmp_path, "seasons", ["year", "url"], FILES["seasons"])
    with pytest.raises(FileNotFoundError, match="circuits, constructor_results"):
        land(spark, str(tmp_path), racing.CONTRACTS, RUN_TS)
    assert [tuple(r)[:2] for r in landed_files(spark, str(tmp_path), ".csv").collect()] == [("seasons", 1)]


def test_wrong_header_is_refused(spark, tmp_path):
    from sluiceworks.sources import read_csv

    write_csv(tmp_path, "seasons", ["url", "year"], FILES["seasons"])
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "seasons.csv"), racing.CONTRACTS["seasons"], RUN_TS).collect()


def test_short_and_long_lines_are_seen(spark, tmp_path):
    from sluiceworks.sources import read_csv

    (tmp_path / "seasons.csv").write_text("year,url\n1950,u\n1951\n1952,u,more\n")
    rows = read_csv(spark, str(tmp_path / "seasons.csv"), racing.CONTRACTS["seasons"], RUN_TS)
    assert [r._malformed for r in rows.collect()] == [None, "1951", "1952,u,more"]


def test_reasons_and_cascade(built):
    got = {
        (n, r.reason): r.rows for n, b in built.items() for r in reason_counts(b.rejected).collect()
    }
    assert got == {
        ("circuits", "invalid_lat_lng"): 1, ("drivers", "invalid_dob_range"): 1,
        ("races", "orphan_circuit_id"): 1, ("results", "orphan_race_id"): 1,
        ("results", "orphan_driver_id"): 1, ("sprint_results", "missing_status_id"): 1,
        ("qualifying", "invalid_position_ge_1"): 1, ("lap_times", "exact_duplicate"): 1,
        ("lap_times", "key_conflict"): 2, ("driver_standings", "invalid_points_wins"): 1,
        ("constructor_results", "orphan_race_id"): 1,
    }


def test_accounting_closes(spark, raw, built):
    lines = audit.row_accounting({n: (raw[n], b.trusted, b.rejected) for n, b in built.items()})
    audit.require(lines, "closes", "accounting")
    assert {n: (b.rows, b.clean) for n, b in built.items()} == {
        r.dataset: (r.bronze, r.silver) for r in lines.collect()
    }
    audit.require(
        audit.key_uniqueness(built["lap_times"].trusted, ["race_id", "driver_id", "lap"], "laps"), "is_unique", "laps"
    )
    future = built["races"].trusted.where(F.col("date") > F.to_date(F.lit(racing.SNAPSHOT_DATE)))
    assert future.count() == 1


def test_trusted_results_are_typed(built):
    row = built["results"].trusted.where("result_id = 1").first()
    assert (row.points, row.milliseconds, row.fastest_lap_speed, row.time) == (10.0, 5690616, 218.3, "1:34:50.616")
    assert built["results"].trusted.where("result_id = 2").first().position is None
    assert built["results"].quarantine(RUN_TS).columns[-5:] == [
        "_source_file", "_ingested_at", "_malformed", "_reasons", "_quarantined_at",
    ]


def test_driver_mart(marts):
    got = {(r.season, r.driver_id): tuple(r)[2:] for r in marts["driver_season_summary"].collect()}
    assert got == {
        (2008, 1): ("Ada Lane", "ADA", "British", 2, 1, 2, 1, 18.0, 0, 1),
        (2008, 2): ("Bo Moss", None, "British", 2, 1, 1, 1, 10.0, 1, 1),
        (1954, 2): ("Bo Moss", None, "British", 1, 1, 1, 1, 8.1, 0, 1),
        (1954, 3): ("Bo Moss", None, "Irish", 1, 0, 1, 0, 6.1, 0, 2),
    }


def test_other_marts(marts):
    teams = {(r.season, r.constructor): tuple(r)[4:] for r in marts["constructor_season_summary"].collect()}
    assert teams == {
        (2008, "Ant"): (3, 2, 3, 28.0, 1), (2008, "Bee"): (1, 0, 0, 0.0, None),
        (1954, "Bee"): (2, 1, 2, 14.3, 1),
    }
    stops = [tuple(r) for r in marts["pit_stop_evolution"].collect()]
    assert stops == [(2008, 4, 37.999, 26.898, 25.0)]
    tracks = {r.circuit: tuple(r)[4:] for r in marts["circuit_stats"].collect()}
    assert tracks == {"Alba": (2, 1954, 2008, 2), 'The "Boa", new': (1, 2008, 2008, 1), "Cima": (1, 2026, 2026, 0)}


def test_audits_notice_wrong_numbers(spark, marts):
    right = [("driver_season_summary", 4, 6), ("constructor_season_summary", 3, 6), ("pit_stop_evolution", 1, 4), ("circuit_stats", 3, 4)]
    columns = ("races_entered", "entries", "stops", "races_held")
    watched = {r[0]: (marts[r[0]], c) for r, c in zip(right, columns, strict=True)}
    schema = "mart string, rows_expected bigint, key_sum_expected bigint"
    audit.require(audit.mart_audit(watched, spark.createDataFrame(right, schema)), "ok", "marts")
    wrong = [(n, rows, total + 1) for n, rows, total in right] + [("absent", 1, 1)]
    lines = audit.mart_audit(watched, spark.createDataFrame(wrong, schema)).collect()
    assert len(lines) == 5 and {r.ok for r in lines} == {False}


def test_rebuild_is_identical(spark, raw, built):
    again = build(spark, raw, racing.CONTRACTS)
    names = ["results", "lap_times"]

    def prints(b):
        return audit.union_all([audit.fingerprint(b[n].table.drop("_original"), n) for n in names])

    audit.require(audit.reproducible(prints(built), prints(again)), "identical", "rebuild")


def test_malformed_lines_are_quarantined_whole(spark, tmp_path):
    (tmp_path / "seasons.csv").write_text("year,url\n1950,u\n1951\n1952,u,more\n1950,u,copy\n")
    contracts = {"seasons": racing.CONTRACTS["seasons"]}
    raw = land(spark, str(tmp_path), contracts, RUN_TS)
    built = build(spark, raw, contracts)["seasons"]
    assert (built.rows, built.clean) == (4, 1) and built.trusted.first().year == 1950
    got = {(r._malformed, r._reasons.split(",")[0]) for r in built.rejected.collect()}
    assert got == {(line, "malformed_line") for line in ("1951", "1952,u,more", "1950,u,copy")}
    assert audit.observed_counts(raw).first().malformed_lines == 3


def test_a_build_can_be_repeated_in_place(spark, raw, tmp_path):
    contracts = {n: racing.CONTRACTS[n] for n in ("seasons", "status")}
    some = {n: raw[n] for n in contracts}
    first = build(spark, some, contracts, str(tmp_path))
    again = build(spark, some, contracts, str(tmp_path))
    for n in contracts:
        assert sorted(map(str, first[n].trusted.collect())) == sorted(map(str, again[n].trusted.collect()))


def test_raw_text_is_exact(spark):
    from sluiceworks.sources import as_text

    frame = spark.createDataFrame([(1.2345, 0.004, 1e17, None)], "a double, b double, c double, d double")
    assert tuple(as_text(frame).first()) == ("1.2345", "0.004", "1.0E17", None)
