"""Row-level rules of Silver, with the default (Arabic) contract."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from reqlytics.contract import Contract
from reqlytics.plans import dimensions, fact
from reqlytics.plans.load import bronze_schema
from reqlytics.plans.silver import build_silver

DONE, BUSY = "تم التنفيذ", "جاري العمل"
AGAIN, ONCE = "مكرر", "غير مكرر"
NOW = dt.datetime(2026, 10, 7)


def bronze(spark, rows):
    data = [
        (i, *row, "f.csv", "2026Q1", "hash", "batch", NOW) for i, row in enumerate(rows, start=3)
    ]
    return spark.createDataFrame(data, bronze_schema())


@pytest.fixture(scope="module")
def silver(spark):
    rows = [
        ("نظافة  حاوية", "الملقا", DONE, "5", "2026-01-01 10:00:00", AGAIN),
        ("إنارة", " بلدية الشمال", "3", "18:00 00:00", "2026-06-30", ONCE),
        ("نوع البلاغ", "الموقع", "x", "y", "z", "w"),
        (None, None, BUSY, None, "2026-01-02", None),
        ("إنارة", "بلدية", None, "nan", "bad", AGAIN),
        ("إنارة", "بلديةس", DONE, "-1", "2026-01-01", "other"),
        ("إنارة", "س", DONE, "nan", "2026-01-01", AGAIN),
        ("إنارة", "س", DONE, "721", "2026-01-01", AGAIN),
        ("إنارة", "س", "0", "06:00 12:00", "2026-01-01", AGAIN),
        ("إنارة", "س", None, "5", "2026-01-01", AGAIN),
    ]
    return {r["source_row_number"]: r for r in build_silver(bronze(spark, rows)).collect()}


def test_header_rows_go_and_null_issues_stay(silver):
    assert sorted(silver) == [3, 4, 6, 7, 8, 9, 10, 11, 12]
    assert silver[6]["issue_type_ar"] is None


def test_layout_a(silver):
    r = silver[3]
    assert r["request_sk"] == hashlib.md5(b"hash-3").hexdigest()
    assert (r["source_layout"], r["status_code"], r["closure_hours"]) == ("A", "completed", 5.0)
    assert r["issue_type_ar"] == "نظافة حاوية"
    assert r["received_at"] == dt.datetime(2026, 1, 1, 10) and r["has_received_time"] is True
    assert (r["closure_basis"], r["is_closure_kpi_eligible"], r["time_band"]) == ("status_confirmed", True, None)
    assert r["is_repeated"] is True and r["is_municipality_level"] is False


def test_layout_b_swaps_the_slots(silver):
    r = silver[4]
    assert (r["source_layout"], r["status_ar"], r["status_code"]) == ("B", None, "not_published")
    assert (r["closure_hours"], r["time_band"]) == (3.0, "18:00 00:00")
    assert (r["closure_basis"], r["is_closure_kpi_eligible"]) == ("closure_value_only", True)
    assert r["has_received_time"] is False and r["is_municipality_level"] is True
    assert silver[11]["is_zero_closure"] is True and silver[11]["is_closure_kpi_eligible"] is True


def test_nulls_stay_null(silver):
    r = silver[6]
    assert r["status_code"] == "in_progress" and r["is_repeated"] is None
    assert r["is_location_missing"] is True and r["is_municipality_level"] is None
    assert r["closure_hours"] is None and r["is_closure_kpi_eligible"] is False
    assert (r["is_zero_closure"], r["is_closure_outlier"], r["closure_basis"]) == (False, False, None)


def test_unknown_status_and_unreadable_date(silver):
    r = silver[7]
    assert r["status_code"] == "unknown" and r["is_municipality_level"] is True
    assert (r["received_at"], r["received_date"], r["has_received_time"]) == (None, None, None)


def test_odd_hours(silver):
    assert silver[12]["is_closure_kpi_eligible"] is None  # hours, but a status that is not known
    negative, nan, long = silver[8], silver[9], silver[10]
    assert negative["is_closure_kpi_eligible"] is False and negative["closure_basis"] == "status_confirmed"
    assert negative["is_municipality_level"] is False
    assert nan["closure_basis"] == "status_confirmed" and nan["is_closure_kpi_eligible"] is False
    assert (nan["is_zero_closure"], nan["is_closure_outlier"]) == (False, False)
    assert long["is_closure_outlier"] is True and long["is_closure_kpi_eligible"] is True


def test_one_pass_without_shuffle(spark):
    plan = build_silver(bronze(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_calendar_of_nothing_is_empty(spark):
    assert dimensions.build_dim_date(build_silver(bronze(spark, []))).count() == 0


def test_report_drops_dateless_rows_and_keeps_labels(spark):
    rows = [
        ("a", None, DONE, "5", "2026-01-01", AGAIN),
        ("a", None, DONE, "5", "unreadable", AGAIN),
        ("b", "x", "4", "06:00 12:00", "2026-01-03", ONCE),
    ]
    layer = build_silver(bronze(spark, rows))
    columns = "issue_type_ar issue_code issue_ar issue_en department_ar department_en domain_ar domain_en translation_source"
    issue_map = spark.createDataFrame(
        [("a", "I1", "a", "A", "d", "D", "m", "M", "official")], " string, ".join(columns.split()) + " string"
    )
    location_map = spark.createDataFrame(
        [("غير متوفر في المصدر", "غير متوفر في المصدر", "Missing", "missing", "م", "Missing")],
        "location_ar string, location_label_ar string, location_en string, location_type string, "
        "location_type_ar string, location_type_en string",
    )
    facts = fact.build_fact(layer, issue_map)
    assert {r["issue_key"] for r in facts.collect()} == {"I1", "UNMAPPED"}
    places = dimensions.build_dim_location(layer, location_map)
    report = fact.build_report(
        facts, dimensions.build_dim_date(layer), dimensions.build_dim_issue(issue_map), places,
        dimensions.build_dim_status(spark),
    ).collect()
    assert len(report) == 2
    by_issue = {r["issue_code"]: r for r in report}
    assert by_issue["I1"]["location_type"] == "missing" and by_issue["UNMAPPED"]["location_type"] == "unmapped"
    assert by_issue["UNMAPPED"]["has_published_status"] == 0 and by_issue["I1"]["is_completed_int"] == 1
    days = [str(r["date"]) for r in dimensions.build_dim_date(layer).orderBy("date").collect()]
    assert days == ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert Contract().labels.unmapped in {r["issue_ar"] for r in dimensions.build_dim_issue(issue_map).collect()}
    week = dimensions.build_dim_date(layer).where(F.col("date") == "2026-01-01").first()
    assert (week["iso_week"], week["day_name_en"], week["year_quarter"]) == (1, "Thursday", "2026-Q1")
