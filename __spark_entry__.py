"""Registered queries: every job of the library over the given tables, with its SQL oracle."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from fixtures import derived, oracle  # noqa: E402
from fixtures.workbooks import workbooks  # noqa: E402
from fixtures.world import strict_contract, with_faults, with_gold_faults, world  # noqa: E402
from reqlytics.functions.keys import quarter_code  # noqa: E402
from reqlytics.operators import canonical, median, periods, quadrant  # noqa: E402
from reqlytics.operators.joins import lookup_join  # noqa: E402
from reqlytics.plans import (  # noqa: E402
    dimensions,
    fact,
    kpis,
    performance,
    profile,
    quality,
    validation,
)
from reqlytics.plans import silver as silver_plan  # noqa: E402
from reqlytics.plans.medallion import Medallion  # noqa: E402
from reqlytics.plans.load import (  # noqa: E402
    ReleaseRejected,
    bronze_table,
    load_release,
    read_bronze,
    read_dropped,
    read_manifest,
)
from reqlytics.sources.releases import map_headers, mapped_rows, read_release, workbook_release  # noqa: E402
from reqlytics.sources.warehouse import Warehouse, run_query, scratch_root  # noqa: E402

try:  # the training-data operators can be left out of a build
    from reqlytics.llm.oracle import ORACLE as LLM_ORACLE  # noqa: E402
    from reqlytics.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ImportError:
    LLM_QUERIES, LLM_ORACLE = {}, {}
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

SMALL_SF = "/root/testdata/sf0.001"
PERIOD = ["1998Q1", "1998Q2", "1998Q3", "1998Q4"]

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Values as any engine prints them: doubles to 9 digits, dates and times as text."""
    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 9)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|", "null")
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# ---------------------------------------------------------------- 2.7 layers
def c3_silver(spark, sf):
    built = silver_plan.build_silver(world(spark, sf).bronze, derived.CONTRACT)
    return built.drop("batch_id", "ingested_at")


def c4_dim_date(spark, sf):
    return dimensions.build_dim_date(world(spark, sf).layers.silver)


def c5_dim_issue(spark, sf):
    return dimensions.build_dim_issue(world(spark, sf).issue_map, derived.CONTRACT)


def c6_dim_location(spark, sf):
    w = world(spark, sf)
    return dimensions.build_dim_location(w.layers.silver, w.location_map, derived.CONTRACT)


def c7_dim_status(spark, sf):
    """The fixed members, with the number of requests that carry each."""
    members = dimensions.build_dim_status(spark, derived.CONTRACT)
    used = world(spark, sf).layers.fact.groupBy("status_code").agg(F.count(F.lit(1)).alias("requests"))
    return lookup_join(members, used, "status_code")


def c8_fact(spark, sf):
    w = world(spark, sf)
    return fact.build_fact(w.layers.silver, w.issue_map)


def c9_rpt(spark, sf):
    m = world(spark, sf).layers
    return fact.build_report(m.fact, m.dim_date, m.dim_issue, m.dim_location, m.dim_status)


def _mart(spark: SparkSession, sf: str, min_requests: int) -> DataFrame:
    """Bronze to mart in one chain: Bronze is scanned once, and only the columns it takes."""
    w = world(spark, sf)
    silver = silver_plan.build_silver(w.bronze, derived.CONTRACT)
    return performance.build_issue_performance(
        fact.build_fact(silver, w.issue_map),
        dimensions.build_dim_issue(w.issue_map, derived.CONTRACT),
        min_requests,
    )


def c10_issue_performance(spark, sf):
    return _mart(spark, sf, 30)


def _mart_by_era(spark: SparkSession, sf: str) -> DataFrame:
    """The mart with two long periods, before and since the layout change."""
    m = world(spark, sf).layers
    era = F.when(F.col("source_quarter") < "1998Q2", "before").otherwise("since")
    return performance.build_issue_performance(m.fact.withColumn("source_quarter", era), m.dim_issue)


def c16_persistent_by_era(spark, sf):
    return kpis.persistent(_mart_by_era(spark, sf))


def o5_persistent_bars(spark, sf):
    return kpis.persistent_bars(_mart_by_era(spark, sf))


# ---------------------------------------------------------------- 2.7 dashboard
def over_rpt(job: Callable, *args, **kwargs) -> Query:
    return lambda spark, sf: job(world(spark, sf).layers.rpt, *args, **kwargs)


def over_mart(job: Callable, *args, **kwargs) -> Query:
    return lambda spark, sf: job(world(spark, sf).layers.mart, *args, **kwargs)


def c17_locations(spark, sf):
    w = world(spark, sf)
    return kpis.locations(w.layers.rpt, None, w.coordinates)


def p41_placement(spark, sf):
    return kpis.placement_summary(c17_locations(spark, sf))


def p41_placed(spark, sf):
    return kpis.placed_locations(c17_locations(spark, sf))


def o4_top_locations(spark, sf):
    return kpis.top_locations(c17_locations(spark, sf))


def s16_parameterised_sql(spark, sf):
    return run_query(
        spark,
        """
        SELECT source_quarter, domain_en, count(*) AS requests, sum(is_completed_int) AS completed
        FROM {rpt} WHERE array_contains(:quarters, source_quarter) GROUP BY ALL
        """,
        PERIOD,
        rpt=world(spark, sf).layers.rpt,
    )


# ---------------------------------------------------------------- 2.1 / 2.2 releases
def _rows_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return world(spark, sf).bronze.withColumn("source_path", F.col("source_file"))


def c1_validation_rows(spark, sf):
    return validation.row_report(validation.row_profile(_rows_by_file(spark, sf), derived.CONTRACT))


def c1_validation_strict(spark, sf):
    return validation.row_report(validation.row_profile(_rows_by_file(spark, sf), strict_contract()))


def c1_validation_report(spark, sf):
    w = world(spark, sf)
    report = validation.validate_release(w.release, w.contract)
    return report.withColumn("source_path", w.release_of(F.col("source_path")))


def c1_validation_warnings(spark, sf):
    w = world(spark, sf)
    report = validation.validate_release(w.release, strict_contract())
    return report.withColumn("source_path", w.release_of(F.col("source_path")))


def c1_rule_reactions(spark, sf):
    """Every reaction to repeated headers, rows of no layout and unknown time bands, per release."""
    w = world(spark, sf)

    def judged(reaction: str) -> DataFrame:
        report = validation.validate_release(w.release, derived.contract_with(reaction))
        return report.select(
            F.lit(reaction).alias("reaction"),
            w.release_of(F.col("source_path")).alias("release"),
            "status",
            F.size("errors").alias("n_errors"),
            F.size("warnings").alias("n_warnings"),
            "embedded_header_rows", "unknown_layout_rows", "layout_a", "layout_b",
            "invalid_time_band", "time_band_examples", "dropped_rows",
        )

    return reduce(DataFrame.unionByName, [judged(r) for r in ("warn", "drop_and_log", "fail")])


def c1_dropped_rows(spark, sf):
    """The log of the rows that a contract drops, written and published with the load."""
    w = world(spark, sf)
    warehouse = Warehouse(spark, scratch_root(spark))
    load_release(warehouse, w.releases, w.quarter_of_file, derived.contract_with("drop_and_log"))
    return read_dropped(warehouse).select("source_quarter", "source_row_number", "rule", "value")


def c3_silver_without_dropped(spark, sf):
    """Silver of a contract that drops rows, and what its reconciliation expects, per quarter."""
    w, contract = world(spark, sf), derived.contract_with("drop_and_log")
    built = silver_plan.build_silver(w.bronze, contract)
    return built.groupBy("source_quarter", "source_layout").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("time_band").alias("banded"), F.sum("source_row_number").alias("row_sum")
    )


def _written_lines(lines: DataFrame) -> str:
    path = f"{scratch_root(lines.sparkSession)}/lines"
    dealt = lines.repartition("release").sortWithinPartitions("release", "line")
    dealt.select("release", "value").write.partitionBy("release").text(path)
    return path


def c1_empty_rows(spark, sf):
    """Releases with rows of empty cells and repeated headers: each row is counted once, as what it is."""
    report = validation.validate_files(spark, _written_lines(derived.sparse_lines(spark, sf)), derived.CONTRACT)
    return report.select(
        F.regexp_extract("source_path", r"release=([^/]+)", 1).cast("long").alias("release"),
        "status", "rows_in_file", "empty_rows", "embedded_header_rows", "data_rows", "layout_a",
    )


def c1_missing_columns(spark, sf):
    """Releases without a required column, with all that is said of them."""
    report = validation.validate_files(spark, _written_lines(derived.faulty_lines(spark, sf)), derived.CONTRACT)
    release = F.regexp_extract("source_path", r"release=([^/]+)", 1).cast("long").alias("release")
    return report.where("status = 'fail' AND size(errors) = 2").select(release, F.array_join("errors", "; ").alias("errors"))


def c2_refused_load(spark, sf):
    """One failing file stops a load before anything is written or logged."""
    warehouse = Warehouse(spark, scratch_root(spark))
    try:
        load_release(warehouse, _written_lines(derived.faulty_lines(spark, sf)), "1998Q1", derived.CONTRACT)
        outcome = "loaded"
    except ReleaseRejected as problem:
        outcome = " ".join(str(problem).split()[:6])
    stored = read_bronze(warehouse, derived.CONTRACT).agg(F.count(F.lit(1)).alias("n_rows"))
    n_entries, n_files = len(bronze_table(warehouse).entries()), read_manifest(warehouse).count()
    return stored.select("n_rows", F.lit(outcome).alias("outcome"), F.lit(n_entries).alias("n_entries"), F.lit(n_files).alias("n_files"))


def s7_lineage(spark, sf):
    """The file, content, batch and time that Bronze names for its rows."""
    w = world(spark, sf)
    batch, at = w.manifest.select("batch_id", F.to_timestamp("ingested_at").alias("at")).first()
    return w.loaded.groupBy("source_quarter", "file_sha256").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("source_row_number").alias("first_row"),
        F.bool_and((F.col("batch_id") == batch) & (F.col("ingested_at") == F.lit(at))).alias("is_this_load"),
        F.bool_and(F.col("source_file").rlike(r"^part-[^/]+\.txt$")).alias("is_named"),
    )


def c1_validation_failures(spark, sf):
    """Releases with a fault each: what cannot be read in full is refused, with its reasons."""
    report = validation.validate_files(spark, _written_lines(derived.faulty_lines(spark, sf)), world(spark, sf).contract)
    return report.select(
        F.regexp_extract("source_path", r"release=([^/]+)", 1).cast("long").alias("release"),
        "status",
        F.size("errors").alias("n_errors"),
        F.regexp_replace(F.get("errors", F.lit(0)), "[^a-z ].*$", "").alias("first_error"),
        "data_rows",
    )


def c2_bronze_lineage(spark, sf):
    w = world(spark, sf)
    return w.loaded.drop("source_file", "file_sha256", "batch_id", "ingested_at")


def s4_file_sha256(spark, sf):
    from reqlytics.sources.releases import file_fingerprints

    w = world(spark, sf)
    prints = file_fingerprints(spark, w.releases)
    return prints.select(w.release_of(F.col("source_path")).alias("release"), "file_sha256", "n_bytes")


def s6_row_numbers(spark, sf):
    w = world(spark, sf)
    return w.release.rows.groupBy(w.release_of(F.col("source_path")).alias("release")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("source_row_number").alias("first_row"),
        F.max("source_row_number").alias("last_row"),
        F.sum("source_row_number").alias("row_sum"),
    )


def s1_workbooks(spark, sf):
    """Every row of the workbooks of a release, as stored, with its number in the sheet; blank rows count."""
    contract = derived.CONTRACT
    release = workbook_release(workbooks(spark, sf), contract)
    rows = mapped_rows(release, map_headers(release.headers, contract), contract)
    return rows.where(F.coalesce(*contract.column_names).isNotNull())


def c1_workbook_report(spark, sf):
    """The validation report of the same workbooks."""
    report = validation.validate_release(workbook_release(workbooks(spark, sf), derived.CONTRACT), derived.CONTRACT)
    return report.select("source_path", "status", "data_rows", "layout_a", "layout_b", "invalid_status_in_layout_a", "invalid_repeat_flag")


def s6_records_across_lines(spark, sf):
    """Releases whose cells hold line ends, read in many splits: every row as stored, with its number in the sheet."""
    w = world(spark, sf)
    release = read_release(spark, w.spanning_releases, w.contract, "64k")  # small files here: a release is cut all the same
    rows = mapped_rows(release, map_headers(release.headers, w.contract), w.contract)
    return rows.withColumn("source_path", w.release_of(F.col("source_path")))


def s10_failed_load(spark, sf):
    """All releases are loaded, and one year again with a batch that a gate turns down: its quarters stay as they were."""
    w = world(spark, sf)
    warehouse = Warehouse(spark, scratch_root(spark))
    first = load_release(warehouse, w.releases, w.quarter_of_file, w.contract, batch_id="first")

    def gate(batch: DataFrame) -> None:
        if not batch.where("source_quarter LIKE '1996Q%'").isEmpty():
            raise ReleaseRejected("this year is not wanted")

    try:
        load_release(warehouse, f"{w.releases}/release=199[67]Q*", w.quarter_of_file, w.contract, gate, "second")
        outcome = "loaded"
    except ReleaseRejected as problem:
        outcome = str(problem)
    stored = read_bronze(warehouse, w.contract).groupBy("source_quarter", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
    files = first.groupBy("source_quarter").agg(F.count(F.lit(1)).alias("n_files"))
    entries = len(bronze_table(warehouse).entries())
    return stored.join(files, "source_quarter").withColumn("outcome", F.lit(outcome)).withColumn("n_entries", F.lit(entries))


def s11_repeated_commit(spark, sf):
    """A load that is repeated under its batch id: one entry in the log, every file once in the manifest."""
    w = world(spark, sf)
    warehouse = Warehouse(spark, scratch_root(spark))
    for _ in range(2):
        load_release(warehouse, f"{w.releases}/release=199[67]Q*", w.quarter_of_file, w.contract, batch_id="again")
    manifest = read_manifest(warehouse).groupBy("source_quarter", "batch_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("rows_loaded").alias("rows_loaded")
    )
    return manifest.withColumn("n_entries", F.lit(len(bronze_table(warehouse).entries())))


def s9_partition_overwrite(spark, sf):
    """One year is loaded a second time: its quarters are replaced, the others stay."""
    w = world(spark, sf)
    first = w.manifest.select("batch_id").distinct()
    again = w.load(f"{w.releases}/release=1996Q*")
    batches = again.select("batch_id").distinct().withColumn("is_reloaded", F.lit(True))
    assert first.count() == 1
    return (
        lookup_join(w.loaded, batches, "batch_id")
        .groupBy("source_quarter")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.bool_and("is_reloaded"), F.lit(False)).alias("is_reloaded"),
        )
    )


def s10_row_reconcile(spark, sf):
    return world(spark, sf).manifest.groupBy("source_quarter").agg(
        F.sum("rows_in_file").alias("rows_in_file"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.bool_and(F.col("rows_in_file") == F.col("rows_loaded")).alias("is_equal"),
    )


def s11_manifest(spark, sf):
    w = world(spark, sf)
    batch = w.manifest.select("batch_id").distinct()
    stored = read_manifest(w.warehouse)
    this_load = stored.join(F.broadcast(batch), "batch_id", "left_semi")  # one row: one load, one batch
    return this_load.groupBy("source_quarter", F.col("validation.status").alias("status")).agg(
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("validation.embedded_header_rows").alias("embedded_header_rows"),
        F.sum("validation.data_rows").alias("data_rows"),
        F.sum("validation.layout_counts.A").alias("layout_a"),
        F.sum("validation.layout_counts.B").alias("layout_b"),
    )


def s14_rebuild_by_partition(spark, sf):
    """One quarter is loaded again with another year's release: only its partitions are built a second time."""
    w = world(spark, sf)
    warehouse = Warehouse(spark, scratch_root(spark))
    table = bronze_table(warehouse)

    def refreshed() -> Medallion:
        job = Medallion(warehouse, read_bronze(warehouse, w.contract), w.issue_map, w.location_map, w.contract)
        job.refresh(table.current(), stop=False)
        return job

    load_release(warehouse, w.releases, w.quarter_of_file, w.contract)
    first = set(run for _, run in refreshed().built_from().values())
    load_release(warehouse, f"{w.releases}/release=1997Q1*", "1996Q1", w.contract)
    again = sorted(q for q, (_, run) in refreshed().built_from().items() if run not in first)
    gold = {n: spark.read.parquet(warehouse.path("gold", n)) for n in ("fact_requests", "issue_performance", "hour_counts")}
    fact = gold["fact_requests"].groupBy("source_quarter").agg(F.count(F.lit(1)).alias("n_rows"))
    mart = gold["issue_performance"].groupBy("source_quarter").agg(F.sum("total_requests").alias("in_mart"))
    hours = gold["hour_counts"].groupBy("source_quarter").agg(F.sum("repeated").alias("repeated"))
    joined = fact.join(mart, "source_quarter").join(hours, "source_quarter")
    return joined.withColumn("is_rebuilt", F.col("source_quarter").isin(again))


def a11_stored_counts(spark, sf):
    """Headline figures of several periods from the stored counts alone."""
    w = world(spark, sf)
    chosen = {"first": ["1992Q1"], "pair": ["1992Q2", "1997Q3"], "year": PERIOD, "all": None}
    parts = [kpis.kpis(w.layers.hours, q).withColumn("period", F.lit(name)) for name, q in chosen.items()]
    return reduce(DataFrame.unionByName, parts)


def s13_seed_scan(spark, sf):
    return world(spark, sf).location_map


# ---------------------------------------------------------------- 2.8 checks
def _tables(spark: SparkSession, sf: str, faulty: bool = False) -> quality.Tables:
    w = world(spark, sf)
    m = w.layers
    frames = {
        "bronze": w.bronze, "issue_map": w.issue_map, "location_map": w.location_map,
        "silver": with_faults(m.silver) if faulty else m.silver,
        "dim_date": m.dim_date, "dim_issue": m.dim_issue,
        "dim_location": m.dim_location, "dim_status": m.dim_status,
        "fact": m.fact, "rpt": m.rpt, "mart": m.mart,
    }
    return quality.Tables(with_gold_faults(frames) if faulty else frames)


def checks_of(*kinds: str, faulty: bool = False) -> Query:
    """All checks of some kinds; ``faulty``: on layers with seeded faults, so that each has something to find."""
    def run(spark, sf):
        chosen = [c for c in quality.all_checks(derived.CONTRACT) if c.kind in kinds]
        return quality.run_checks(_tables(spark, sf, faulty), chosen, derived.CONTRACT)

    return run


def q5_fault_severity(spark, sf):
    """The Silver checks on rows with seeded faults: failures meet the declared limits."""
    checks = quality.silver_checks(derived.CONTRACT)
    return quality.run_checks(_tables(spark, sf, faulty=True), checks, derived.CONTRACT)


def q7_unmapped_issues(spark, sf):
    w = world(spark, sf)
    return quality.unmapped_issues(w.layers.silver, w.issue_map)


def q8_unmapped_locations(spark, sf):
    w = world(spark, sf)
    return quality.unmapped_locations(w.layers.silver, w.location_map)


def failing(rule: str) -> Query:
    """Requests that break a row rule, on Silver with seeded faults."""
    return lambda spark, sf: quality.failing_rows(with_faults(world(spark, sf).layers.silver), rule)


def reconciliation(name: str, faulty: bool = False) -> Query:
    def run(spark, sf):
        tables = _tables(spark, sf, faulty)
        if faulty:  # rows are lost on the way to Silver
            lost = tables.frames | {"silver": tables["silver"].where("source_row_number % 83 <> 0")}
            tables = quality.Tables(lost)
        return quality.reconcile(*quality.totals(tables, name, derived.CONTRACT))

    return run


def q16_suite_summary(spark, sf):
    checks = quality.all_checks(derived.CONTRACT)
    return quality.suite_summary(quality.run_checks(_tables(spark, sf), checks, derived.CONTRACT), checks)


# ---------------------------------------------------------------- 2.9 profiles
def n1_variants(spark, sf):
    return canonical.spelling_variants(world(spark, sf).bronze, "issue_type_raw")


def n2_truncated(spark, sf):
    return canonical.truncated_names(world(spark, sf).bronze, "location_raw")


def n3_layout_runs(spark, sf):
    return profile.layout_runs(world(spark, sf).bronze, derived.CONTRACT)


def n4_slot_profile(spark, sf):
    return profile.slot_profile(world(spark, sf).bronze, derived.CONTRACT)


# ---------------------------------------------------------------- the same operators on other tables
def d1_documents_normalise(spark, sf):
    """Documents whose whole text is the same once spacing and joining marks are ignored."""
    return canonical.text_groups(derived.table(spark, sf, "documents"), "text")


def d2_lineitem_median_matrix(spark, sf):
    """Quadrant by (ship quarter, part type): median price against the share of returns."""
    parts = derived.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = derived.table(spark, sf, "lineitem").select(
        "l_partkey",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        quarter_code(F.col("l_shipdate")).alias("period"),
        "l_extendedprice",
        (F.col("l_returnflag") == "R").alias("is_returned"),
    )
    typed = lookup_join(lines, parts, "l_partkey", "inner", F.col("line"))
    cells = median.aggregate_rows_with_median(
        typed, ["period", "p_type"], "l_extendedprice",
        [F.count(F.lit(1)).alias("n"), F.count_if("is_returned").alias("returned")],
        [F.sum("n").alias("line_items"), F.sum("returned").alias("returned")],
        "median_price",
    ).withColumn("return_rate", F.try_divide("returned", "line_items"))
    return quadrant.with_quadrant(
        cells, "period", "line_items", "median_price", "return_rate", "returned", "line_items", 5,
        "price_limit", "return_limit", "price_group",
    )


def a10_median_by_rank(spark, sf):
    """The median by rank selection straight from the rows, the way taken for groups with too many distinct values."""
    return median.aggregate_rows_with_median(
        derived.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
        [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("line_items")], "median_price", max_values=0,
    )


def a10_median_by_counts(spark, sf):
    """The same from a count table, by rank selection over counted values."""
    counts = (
        derived.table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_quantity")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return median.aggregate_with_median(
        counts, ["l_returnflag"], "l_quantity", "n", [F.sum("n").alias("line_items")], "median_quantity", max_values=0,
    )


def a10_median_mixed(spark, sf):
    """Groups of many and of few rows, of values that repeat and of those that do not, in one call."""
    lines = derived.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, "first").otherwise(F.col("l_suppkey").cast("string")).alias("kind"),
        F.col("l_extendedprice").alias("v"),
    )
    hours = derived.table(spark, sf, "lineitem").select(F.lit(None).cast("string").alias("kind"), F.col("l_quantity").cast("double").alias("v"))
    return median.aggregate_rows_with_median(
        lines.unionByName(hours), ["kind"], "v", [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("line_items")],
        "median_value", max_values=500,
    )


def a11_global_median_by_rank(spark, sf):
    counts = derived.table(spark, sf, "orders").groupBy("o_totalprice").agg(F.count(F.lit(1)).alias("n"))
    return median.aggregate_with_median(
        counts, [], "o_totalprice", "n", [F.sum("n").alias("orders")], "median_price", max_values=0
    )


def a10_median_narrow_range(spark, sf):
    """Rank selection where all values lie close together, far from zero."""
    counts = (
        derived.table(spark, sf, "lineitem")
        .select("l_returnflag", (F.lit(1e9) + F.col("l_orderkey") + F.col("l_extendedprice") / 1e6).alias("v"))
        .groupBy("l_returnflag", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return median.aggregate_with_median(
        counts, ["l_returnflag"], "v", "n", [F.sum("n").alias("line_items")], "median_value", max_values=0
    )


def d3_events_period_delta(spark, sf):
    """Weekly volume and median per event type against the week before."""
    weekly = (
        derived.table(spark, sf, "events")
        .withColumn("week", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
        .groupBy("event_type", "week", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    figures = median.aggregate_with_median(
        weekly, ["event_type", "week"], "value", "n", [F.sum("n").alias("events")], "median_value"
    )
    seen = periods.with_previous(figures, "week", ["events", "median_value"], ["event_type"])
    return seen.select(
        "event_type", "week", "prev_week", "events", "median_value",
        (F.try_divide("events", "prev_events") - 1).alias("events_change"),
        periods.judge(F.col("median_value") - F.col("prev_median_value")).alias("median_verdict"),
    )


REGISTERED: dict[str, Query] = {
    "c1_rule_reactions": c1_rule_reactions,
    "c1_dropped_rows": c1_dropped_rows,
    "c1_validation_report": c1_validation_report,
    "c1_validation_warnings": c1_validation_warnings,
    "c1_validation_failures": c1_validation_failures,
    "c1_empty_rows": c1_empty_rows,
    "c1_missing_columns": c1_missing_columns,
    "c2_refused_load": c2_refused_load,
    "s7_lineage": s7_lineage,
    "c1_validation_rows": c1_validation_rows,
    "c1_validation_strict": c1_validation_strict,
    "c2_bronze_lineage": c2_bronze_lineage,
    "c3_silver": c3_silver,
    "c3_silver_without_dropped": c3_silver_without_dropped,
    "c4_dim_date": c4_dim_date,
    "c5_dim_issue": c5_dim_issue,
    "c6_dim_location": c6_dim_location,
    "c7_dim_status": c7_dim_status,
    "c8_fact": c8_fact,
    "c9_rpt": c9_rpt,
    "c10_issue_performance": c10_issue_performance,
    "c11_quarters": over_rpt(kpis.available_quarters),
    "c12_kpis": over_rpt(kpis.kpis, PERIOD),
    "c12_kpis_all": over_rpt(kpis.kpis),
    "c13_published_gate": over_rpt(kpis.published_gate, PERIOD),
    "c13_published_gate_late": over_rpt(kpis.published_gate, ["2000Q1", "2000Q2"]),
    "c14_domains": over_rpt(kpis.domains, PERIOD),
    "c15_matrix": over_mart(kpis.matrix, PERIOD),
    "c16_persistent": over_mart(kpis.persistent),
    "c16_persistent_by_era": c16_persistent_by_era,
    "c17_locations": c17_locations,
    "c18_trend": over_rpt(kpis.trend, PERIOD),
    "c18_trend_all": over_rpt(kpis.trend, None, "ar"),
    "c19_reliability": over_rpt(kpis.reliability, PERIOD),
    "c20_group_volume": over_mart(kpis.group_volume, None, "ar"),
    "c21_most_repeated": over_mart(kpis.most_repeated, PERIOD),
    "c22_review_first": over_mart(kpis.review_first, PERIOD),
    "c23_flagged_summary": over_mart(kpis.flagged_summary, PERIOD),
    "c24_period_delta": over_rpt(kpis.period_delta),
    "c25_bubbles": over_mart(kpis.bubbles, PERIOD, "ar"),
    "o4_top_locations": o4_top_locations,
    "o5_persistent_bars": o5_persistent_bars,
    "o6_domain_bars": over_rpt(kpis.domain_bars),
    "p37_period_labels": over_rpt(kpis.period_labels),
    "p37_period_labels_ar": over_rpt(kpis.period_labels, "ar"),
    "p41_placement": p41_placement,
    "p41_placed": p41_placed,
    "s1_workbooks": s1_workbooks,
    "c1_workbook_report": c1_workbook_report,
    "s4_file_sha256": s4_file_sha256,
    "s6_row_numbers": s6_row_numbers,
    "s6_records_across_lines": s6_records_across_lines,
    "s9_partition_overwrite": s9_partition_overwrite,
    "s10_failed_load": s10_failed_load,
    "s11_repeated_commit": s11_repeated_commit,
    "s10_row_reconcile": s10_row_reconcile,
    "s11_manifest": s11_manifest,
    "s13_seed_scan": s13_seed_scan,
    "s14_rebuild_by_partition": s14_rebuild_by_partition,
    "s16_parameterised_sql": s16_parameterised_sql,
    "q1_unique": checks_of("unique"),
    "q1_unique_faults": checks_of("unique", faulty=True),
    "q2_not_null": checks_of("not_null"),
    "q3_accepted_values": checks_of("accepted"),
    "q4_foreign_keys": checks_of("reference"),
    "q4_foreign_keys_faults": checks_of("reference", faulty=True),
    "q5_fault_severity": q5_fault_severity,
    "q6_mapping_warnings": checks_of("unmapped"),
    "q7_unmapped_issues": q7_unmapped_issues,
    "q8_unmapped_locations": q8_unmapped_locations,
    "q9_negative_hours": failing("closure_hours_negative"),
    "q10_mart_reconciles": reconciliation("mart_reconciles_with_fact"),
    "q10_mart_reconciles_faults": reconciliation("mart_reconciles_with_fact", faulty=True),
    "q11_outside_quarter": failing("received_outside_quarter"),
    "q12_rpt_reconciles": reconciliation("rpt_reconciles_with_fact"),
    "q12_rpt_reconciles_faults": reconciliation("rpt_reconciles_with_fact", faulty=True),
    "q13_silver_reconciles": reconciliation("silver_reconciles_with_bronze"),
    "q13_silver_reconciles_faults": reconciliation("silver_reconciles_with_bronze", faulty=True),
    "q14_band_layout": failing("time_band_against_layout"),
    "q16_suite_summary": q16_suite_summary,
    "n1_variants": n1_variants,
    "n2_truncated": n2_truncated,
    "n3_layout_runs": n3_layout_runs,
    "n4_slot_profile": n4_slot_profile,
    "d1_documents_normalise": d1_documents_normalise,
    "d2_lineitem_median_matrix": d2_lineitem_median_matrix,
    "d3_events_period_delta": d3_events_period_delta,
    "a10_median_by_rank": a10_median_by_rank,
    "a10_median_by_counts": a10_median_by_counts,
    "a10_median_mixed": a10_median_mixed,
    "a10_median_narrow_range": a10_median_narrow_range,
    "a11_global_median_by_rank": a11_global_median_by_rank,
    "a11_stored_counts": a11_stored_counts,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the issue-performance mart. The small scale has few requests per cell, hence 3."""
    return comparable(_mart(spark, SMALL_SF, 3))


def queries() -> dict[str, Query]:
    def finished(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    registered = {name: finished(query) for name, query in REGISTERED.items()} | LLM_QUERIES
    if corpus_pipeline is not None:
        registered["pipeline"] = corpus_pipeline.run
    return registered


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements() | LLM_ORACLE
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
