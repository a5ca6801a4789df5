"""The check suite: severities, gates, and the check on the number of checks."""

from dataclasses import replace

import pytest

from fixtures import derived
from fixtures.world import with_faults, world
from reqlytics.plans import kpis, quality
from reqlytics.plans.load import bronze_table, load_release, read_bronze
from reqlytics.plans.medallion import Medallion
from reqlytics.sources.warehouse import Warehouse, remove, scratch_root

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    return world(spark, SF).layers


def tables(layers, **changed):
    names = "bronze silver issue_map location_map dim_date dim_issue dim_location dim_status fact mart rpt".split()
    return quality.Tables({**{n: getattr(layers, n) for n in names}, **changed})


def outcome(results):
    return {r["check_name"]: (r["failures"], r["status"]) for r in results.collect()}


def test_every_declared_check_runs_once(layers):
    checks = quality.all_checks(derived.CONTRACT)
    assert len(checks) == len({c.name for c in checks}) == 46
    results = quality.run_checks(tables(layers), checks, derived.CONTRACT)
    got = outcome(results)
    assert set(got) == {c.name for c in checks}
    assert {n for n, (_, s) in got.items() if s == "error"} == set()
    assert got["not_null_silver_location_ar"][1] == "warn"  # some, but no more than the limit
    assert got["issue_types_unmapped"] == (1, "warn")
    rows = quality.gate(results, checks)
    assert len(rows) == 46


def test_seeded_faults_are_found(layers):
    faulty = tables(layers, silver=with_faults(layers.silver))
    got = outcome(quality.run_checks(faulty, quality.silver_checks(derived.CONTRACT), derived.CONTRACT))
    found = {n for n, (failures, _) in got.items() if failures}
    assert found >= {
        "unique_silver_request_sk", "closure_hours_negative", "received_outside_quarter", "time_band_against_layout",
        "accepted_silver_time_band", "accepted_silver_status_code", "not_null_silver_repeat_flag_ar",
        "not_null_silver_issue_type_ar", "accepted_silver_source_layout",
    }
    assert got["unique_silver_request_sk"] == (1, "error")
    with pytest.raises(quality.QualityGate, match="closure_hours_negative"):
        checks = quality.silver_checks(derived.CONTRACT)
        quality.gate(quality.run_checks(faulty, checks, derived.CONTRACT), checks)


def test_orphans_and_lost_rows(layers):
    broken = tables(
        layers, dim_status=layers.dim_status.where("status_code <> 'completed'"), rpt=layers.rpt.limit(10)
    )
    got = outcome(quality.run_checks(broken, quality.gold_checks(), derived.CONTRACT))
    completed = layers.fact.where("status_code = 'completed'").count()
    assert got["reference_fact_status_code"] == (completed, "error")
    assert got["rpt_reconciles_with_fact"] == (1, "error") and got["mart_reconciles_with_fact"] == (0, "pass")


def test_thresholds(spark):
    frame = spark.createDataFrame([(None,)] * 3 + [("x",)], "c string")
    def status(warn_above, error_above):
        check = quality.not_null("t", "c", warn_above, error_above)
        return outcome(quality.run_checks(quality.Tables({"t": frame}), [check]))["not_null_t_c"][1]

    assert [status(3, 5), status(2, 5), status(0, 2), status(0, None)] == ["pass", "warn", "error", "warn"]


def test_checks_on_empty_tables_still_report(spark):
    empty = spark.createDataFrame([], "k string")
    checks = [*quality.key("t", "k"), quality.reference("t", "k", "p")]
    got = outcome(quality.run_checks(quality.Tables({"t": empty, "p": empty}), checks))
    assert len(got) == 3 and all(v == (0, "pass") for v in got.values())


def test_missing_check_stops_the_gate(spark):
    frame = spark.createDataFrame([("x",)], "k string")
    checks = quality.key("t", "k")
    results = quality.run_checks(quality.Tables({"t": frame}), checks)
    with pytest.raises(quality.QualityGate, match="1 checks ran, 2"):
        quality.gate(results.limit(1), checks)


def test_failing_layer_blocks_the_next(spark):
    w = world(spark, SF)
    contract = replace(derived.CONTRACT, time_bands=("00:00 06:00",))
    root = scratch_root(spark)
    medallion = Medallion(Warehouse(spark, root), w.bronze, w.issue_map, w.location_map, contract)
    with pytest.raises(quality.QualityGate, match="accepted_silver_time_band"):
        medallion.run()
    assert "fact" not in medallion.__dict__ and "dim_date" not in medallion.__dict__


def test_failing_fact_blocks_report_and_mart(spark, monkeypatch):
    w = world(spark, SF)
    medallion = Medallion(Warehouse(spark, scratch_root(spark)), w.bronze, w.issue_map, w.location_map, w.contract)
    twice = w.layers.fact.unionByName(w.layers.fact)
    monkeypatch.setattr("reqlytics.plans.fact.build_fact", lambda *a, **k: twice)
    with pytest.raises(quality.QualityGate, match="unique_fact_request_sk"):
        medallion.run()
    assert "fact" in medallion.__dict__ and "rpt" not in medallion.__dict__ and "mart" not in medallion.__dict__


def test_whole_run_passes(spark):
    w = world(spark, SF)
    medallion = Medallion(Warehouse(spark, scratch_root(spark)), w.bronze, w.issue_map, w.location_map, w.contract)
    assert len(medallion.run()) == 46
    assert medallion.rpt.count() == medallion.fact.count()


def test_keys_are_compared_only_where_hashes_repeat(spark, monkeypatch):
    rows = [(f"key {i % 900}", f"other {i}", None if i % 2 else f"n{i}") for i in range(1000)]
    tables = quality.Tables({"t": spark.createDataFrame(rows, "a string, b string, c string")})
    checks = [quality.unique("t", c) for c in "abc"]
    assert outcome(quality.run_checks(tables, checks)) == {
        "unique_t_a": (100, "error"), "unique_t_b": (0, "pass"), "unique_t_c": (0, "pass"),
    }
    # two keys of one hash are still two keys
    real = quality.repeated_hashes
    monkeypatch.setattr(quality, "repeated_hashes", lambda *a: real(*a).unionByName(
        spark.createDataFrame([("other 1",)], "k string").selectExpr("1 AS check", "xxhash64(k) AS h")))
    assert outcome(quality.run_checks(tables, checks))["unique_t_b"] == (0, "pass")


def test_key_check_shuffles_hashes_not_keys(spark):
    frame = spark.range(100).selectExpr("repeat(cast(id AS string), 40) AS k")
    plan = quality.repeated_hashes(quality.Tables({"t": frame}), [quality.unique("t", "k")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.split("Exchange hashpartitioning(")[1].split(")")[0]
    assert "h#" in exchange and "k#" not in exchange


# ---------------------------------------------------------------- rebuild of what changed
GOLD = ["fact_requests", "rpt_requests", "issue_performance", "hour_counts", "dim_date", "dim_location", "dim_issue", "dim_status"]


def tables_of(spark, root):
    frames = {n: spark.read.parquet(f"{root}/gold/{n}") for n in GOLD}
    return {n: sorted(map(str, f.select(sorted(f.columns)).collect())) for n, f in frames.items()}


def test_refresh_builds_what_changed_and_equals_a_full_build(spark, tmp_path):
    w = world(spark, SF)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    table = bronze_table(warehouse)

    def job(at=warehouse, contract=w.contract):
        return Medallion(at, read_bronze(warehouse, contract), w.issue_map, w.location_map, contract)

    def load(pattern, quarter, **more):
        load_release(warehouse, f"{w.releases}/release={pattern}", quarter, w.contract, **more)

    load("1995Q*", w.quarter_of_file, batch_id="first")
    assert len(job().refresh(table.current(), stop=False)) == 46
    assert job().refresh(table.current()) == []
    load("1996Q2*", "1995Q1", batch_id="second")
    load("1996Q3*", "1996Q3", batch_id="third")
    remove(spark, table.folder("first") + "/source_quarter=1995Q2")  # nothing of other quarters is read any more
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "wh" / "gold" / "rpt_requests").rglob("*.parquet")}
    checks = job().refresh(table.current(), stop=False)
    assert len(checks) == 46 and all(r["status"] == "pass" for r in checks if r["kind"] == "reconcile")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "wh" / "gold" / "rpt_requests").rglob("*.parquet")}
    moved = {p.parent.name for p in set(before.items()) ^ set(after.items()) for p in [p[0]]}
    assert moved == {"source_quarter=1995Q1", "source_quarter=1996Q3"}
    assert {q for q, (_, run) in job().built_from().items() if run == job().built_from()["1996Q3"][1]} == {"1995Q1", "1996Q3"}

    load("1995Q2*", w.quarter_of_file, batch_id="fourth")  # whole again
    job().refresh(table.current(), stop=False)
    whole = Medallion(Warehouse(spark, str(tmp_path / "full")), read_bronze(warehouse, w.contract), w.issue_map, w.location_map, w.contract)
    whole.run(stop=False)
    assert tables_of(spark, str(tmp_path / "wh")) == tables_of(spark, str(tmp_path / "full"))

    (tmp_path / "empty.csv").write_text("t\n" + ",".join(derived.HEADERS) + "\n")
    load_release(warehouse, str(tmp_path / "empty.csv"), "1995Q1", w.contract)  # a quarter that is emptied goes
    job().refresh(table.current(), stop=False)
    assert "1995Q1" not in {r[0] for r in spark.read.parquet(f"{tmp_path}/wh/gold/rpt_requests").select("source_quarter").distinct().collect()}
    assert "1995Q1" not in job().built_from()
    other = job(contract=replace(w.contract, time_bands=("00:00 06:00",)))
    assert other.built_from() == {}  # other settings: everything is built again


def test_stored_counts_answer_for_any_periods(spark, monkeypatch):
    layers = world(spark, SF).layers
    counts, rpt = layers.hours, layers.rpt
    assert counts.count() < rpt.count()
    plan = kpis.kpis(counts, ["1993Q1", "1995Q2"])._jdf.queryExecution().executedPlan().toString()
    assert "rpt_requests" not in plan and "hour_counts" in plan
    for quarters in (None, ["1993Q1", "1995Q2"], []):
        assert kpis.kpis(counts, quarters).collect() == kpis.kpis(rpt, quarters).collect()
        assert kpis.published_gate(counts, quarters).collect() == kpis.published_gate(rpt, quarters).collect()
    assert sorted(kpis.period_delta(counts).collect()) == sorted(kpis.period_delta(rpt).collect())
