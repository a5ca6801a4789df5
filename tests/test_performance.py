"""The mart and the KPIs on hand-made facts."""

import pytest

from reqlytics.functions.labels import DELAY, EFFECTIVE, INSUFFICIENT, PRIORITY, ROOT_CAUSE
from reqlytics.plans import kpis, performance

FACT = (
    "source_quarter string, issue_key string, status_code string, is_repeated boolean, "
    "closure_hours double, is_closure_kpi_eligible boolean"
)
DIM = "issue_key string, issue_ar string, issue_en string, domain_ar string, domain_en string"


def mart_of(spark, rows, min_requests=2):
    keys = sorted({r[1] for r in rows} - {"unknown"})
    dim = spark.createDataFrame([(k, f"ar {k}", k, "ar", "en") for k in keys], DIM)
    built = performance.build_issue_performance(spark.createDataFrame(rows, FACT), dim, min_requests)
    return {(r["source_quarter"], r["issue_key"]): r for r in built.collect()}


def requests(quarter, issue, hours, repeated, status="completed", eligible=True):
    return [(quarter, issue, status, flag, h, eligible) for h, flag in zip(hours, repeated)]


def test_groups_and_limits(spark):
    rows = [
        *requests("2026Q1", "fast_once", [1.0, 3.0], [False, False]),
        *requests("2026Q1", "fast_again", [4.0, 4.0], [True, True]),
        *requests("2026Q1", "slow_once", [10.0, 30.0], [False, False]),
        *requests("2026Q1", "slow_again", [9.0, 9.0], [True, True]),
        *requests("2026Q1", "rare", [1000.0], [True]),
    ]
    mart = mart_of(spark, rows)
    groups = {k[1]: r["resolution_group"] for k, r in mart.items()}
    assert groups == {
        "fast_once": EFFECTIVE, "fast_again": ROOT_CAUSE, "slow_once": DELAY, "slow_again": PRIORITY, "rare": INSUFFICIENT,
    }
    row = mart["2026Q1", "slow_once"]
    assert row["median_closure_hours"] == 20.0
    assert row["closure_threshold_hours"] == 6.5  # median of 2, 4, 9, 20: the rare issue is no peer
    assert row["repeat_threshold"] == pytest.approx(5 / 9)  # all requests, the rare issue's too
    assert row["issue_quarter_key"] == "2026Q1-slow_once"


def test_unknown_flags_count_in_the_rate_but_not_in_the_limit(spark):
    row = mart_of(spark, requests("2026Q1", "a", [1.0] * 4, [True, None, None, False]))["2026Q1", "a"]
    assert row["repeat_rate"] == 0.25 and row["repeat_threshold"] == 0.5
    assert row["repeated_requests"] == 1 and row["total_requests"] == 4


def test_no_known_flag_leaves_no_limit(spark):
    row = mart_of(spark, requests("2026Q1", "a", [1.0] * 3, [None] * 3))["2026Q1", "a"]
    assert row["repeat_threshold"] is None and row["resolution_group"] == PRIORITY


def test_only_eligible_hours_make_the_median(spark):
    rows = [
        *requests("2026Q1", "a", [1.0, 5.0], [False] * 2),
        *requests("2026Q1", "a", [500.0, -3.0], [False] * 2, "unknown", False),
        *requests("2026Q1", "a", [700.0, 900.0], [False] * 2, "not_published", None),
        *requests("2026Q1", "none", [5.0, 5.0], [False] * 2, "in_progress", False),
        *requests("2026Q1", "unknown", [99.0, 99.0], [True] * 2),
    ]
    mart = mart_of(spark, rows)
    a, none = mart["2026Q1", "a"], mart["2026Q1", "none"]
    assert (a["median_closure_hours"], a["closure_kpi_requests"], a["total_requests"]) == (3.0, 2, 6)
    assert (a["requests_with_status"], a["completion_rate"]) == (2, 1.0)
    assert none["median_closure_hours"] is None and none["resolution_group"] == INSUFFICIENT
    assert none["completion_rate"] == 0.0
    # an issue outside the dimension has no row and no part in the limits
    assert ("2026Q1", "unknown") not in mart and a["repeat_threshold"] == 0.0


RPT = (
    "source_quarter string, is_repeated_int long, is_completed_int long, has_published_status long, "
    "closure_hours_kpi double"
)


def test_headline_figures(spark):
    rows = [("2026Q1", 1, 1, 1, 4.0), ("2026Q1", 0, 0, 1, None), ("2026Q2", None, 0, 0, 8.0), ("2026Q2", 1, 0, 0, 9.0)]
    rpt = spark.createDataFrame(rows, RPT)
    assert tuple(kpis.kpis(rpt).first()) == (4, pytest.approx(2 / 3), 0.5, 2, 8.0)
    assert tuple(kpis.kpis(rpt, ["2026Q2"]).first()) == (2, 1.0, None, 0, 8.5)
    assert tuple(kpis.kpis(rpt, []).first()) == (0, None, None, None, None)
    gate = kpis.published_gate(rpt, ["2026Q2"]).first()
    assert gate["is_published"] is False and gate["completion_shown"] is None
    first, second = kpis.period_delta(rpt).orderBy("source_quarter").collect()
    assert first["prev_source_quarter"] is None and first["total_change"] is None
    assert (second["total_change"], second["median_change"]) == (0.0, 4.5)
    assert (second["median_verdict"], second["repeat_verdict"]) == ("bad", "bad")
    assert second["prev_period"] == "Jan – Mar 2026"


def test_persistent_needs_every_quarter(spark):
    rows = [
        ("2026Q1", "ar a", "a", 10, 0.5, PRIORITY), ("2026Q2", "ar a", "a", 20, 0.7, ROOT_CAUSE),
        ("2026Q1", "ar b", "b", 99, 0.9, PRIORITY), ("2026Q2", "ar b", "b", 99, 0.1, EFFECTIVE),
    ]
    mart = spark.createDataFrame(
        rows, "source_quarter string, issue_ar string, issue_en string, total_requests long, repeat_rate double, "
        "resolution_group string",
    )
    assert [tuple(r) for r in kpis.persistent(mart).collect()] == [("ar a", "a", 30, pytest.approx(0.6))]
    assert kpis.persistent_bars(mart, lang="ar").first()["issue"] == "ar a"
    summary = kpis.flagged_summary(mart, ["2026Q2"]).first()
    assert (summary["flagged_issues"], summary["flagged_requests"], summary["total_requests"]) == (1, 20, 119)
