"""The three jobs as a user runs them, on one small release of each layout."""

import csv

from reqlytics.__main__ import main
from reqlytics.sources.seeds import ISSUE_MAP_COLUMNS, LOCATION_MAP_COLUMNS
from test_releases import HEADERS, ROW_A, ROW_B, as_text, as_workbook


def write_csv(path, header, rows):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out).writerows([header, *rows])
    return str(path)


def test_validate_load_build(spark, tmp_path):
    q1, q2, bad = tmp_path / "q1.csv", tmp_path / "q2.xlsx", tmp_path / "bad.csv"
    q1.write_bytes(as_text([["t"], HEADERS, ROW_A, HEADERS, [*ROW_A[:3], "9", *ROW_A[4:]]]))
    q2.write_bytes(as_workbook([["t"], HEADERS, ROW_B]))
    bad.write_bytes(as_text([["t"], HEADERS[:4], ROW_A[:4]]))
    issues = write_csv(
        tmp_path / "issues.csv", ISSUE_MAP_COLUMNS,
        [[r[0], code, r[0], code, "d", "D", "m", "M", "official"] for r, code in ((ROW_A, "I1"), (ROW_B, "I2"))],
    )
    places = write_csv(
        tmp_path / "places.csv", LOCATION_MAP_COLUMNS,
        [[r[1], r[1], "Place", "neighborhood", "حي", "Neighborhood"] for r in (ROW_A, ROW_B)],
    )
    root = str(tmp_path / "wh")
    assert main(["validate", str(q1)], spark) == 0
    assert main(["validate", str(bad)], spark) == 1
    assert main(["load", str(q1), "2026Q1", "--root", root], spark) == 0
    assert main(["load", str(q2), "2026Q2", "--root", root], spark) == 0
    assert main(["load", str(bad), "2026Q3", "--root", root], spark) == 1
    build = ["build", "--root", root, "--issue-map", issues, "--location-map", places, "--min-requests", "1"]
    assert main(build, spark) == 0
    assert main([*build, "--changed-only"], spark) == 0
    assert main([*build, "--changed-only"], spark) == 0  # nothing to do
    mart = {r["issue_quarter_key"]: r for r in spark.read.parquet(f"{root}/gold/issue_performance").collect()}
    assert set(mart) == {"2026Q1-I1", "2026Q2-I2"}
    assert mart["2026Q1-I1"]["median_closure_hours"] == 7.0 and mart["2026Q1-I1"]["total_requests"] == 2
    # a release in the wrong quarter passes the contract and stops at the layer checks
    assert main(["load", str(q2), "2026Q4", "--root", root], spark) == 0
    assert main([*build, "--changed-only"], spark) == 1
    assert main(build, spark) == 1
