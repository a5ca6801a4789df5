"""Command line: validate release files, load them, build and check the layers.

    spark-submit --py-files reqlytics.zip -m reqlytics validate <path> [--contract c.json]
    python -m reqlytics load <path> <quarter> --root <folder>
    python -m reqlytics build --root <folder> --issue-map <csv> --location-map <csv>
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, functions as F

from reqlytics.contract import MIN_REQUESTS, Contract, load_contract
from reqlytics.plans.load import ReleaseRejected, bronze_table, load_release, read_bronze
from reqlytics.plans.medallion import Medallion
from reqlytics.plans.quality import QualityGate
from reqlytics.plans.validation import failing_files, failure_message, validate_files
from reqlytics.session import SETTINGS
from reqlytics.sources.seeds import read_issue_map, read_location_map
from reqlytics.sources.warehouse import Warehouse, discard_scratch, materialise


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reqlytics")
    top.add_argument("--contract", help="contract document (JSON or YAML)")
    jobs = top.add_subparsers(dest="job", required=True)
    validate = jobs.add_parser("validate")
    validate.add_argument("path", nargs="+")
    validate.add_argument("--report", help="folder to write the whole report to, as JSON")
    load = jobs.add_parser("load")
    load.add_argument("path")
    load.add_argument("quarter")
    load.add_argument("--root", required=True)
    build = jobs.add_parser("build")
    build.add_argument("--root", required=True)
    build.add_argument("--issue-map", required=True)
    build.add_argument("--location-map", required=True)
    build.add_argument("--min-requests", type=int, default=MIN_REQUESTS)
    build.add_argument("--changed-only", action="store_true", help="build only quarters that were loaded since the last such build")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0, or 1 where a file or a layer was rejected."""
    chosen = parser().parse_args(arguments)
    contract = load_contract(chosen.contract) if chosen.contract else Contract()
    spark_is_own = spark is None
    if spark_is_own:
        builder = SparkSession.builder.appName(f"reqlytics {chosen.job}")
        for name, value in SETTINGS.items():
            builder = builder.config(name, value)
        spark = builder.getOrCreate()
    try:
        if chosen.job == "validate":
            report = materialise(validate_files(spark, chosen.path, contract), "validation")
            if chosen.report:
                report.write.mode("overwrite").json(chosen.report)
            failed = failing_files(report)
            report.orderBy(F.col("status") != "fail", "source_path").show(100, truncate=False)
            print(f"{report.count()} file(s)" + (f", all in {chosen.report}" if chosen.report else ""))
            if failed.isEmpty():
                return 0
            print(failure_message(failed), file=sys.stderr)
            return 1
        warehouse = Warehouse(spark, chosen.root)
        if chosen.job == "load":
            manifest = load_release(warehouse, chosen.path, chosen.quarter, contract)
            manifest.show(100, truncate=False)
            print(f"{manifest.count()} file(s), all in {warehouse.path('manifests', 'loads')}")
            return 0
        medallion = Medallion(
            warehouse,
            read_bronze(warehouse, contract),
            read_issue_map(spark, chosen.issue_map),
            read_location_map(spark, chosen.location_map),
            contract,
            chosen.min_requests,
        )
        rows = medallion.refresh(bronze_table(warehouse).current()) if chosen.changed_only else medallion.run()
        for row in rows:
            print(f"{row['status']:<6}{row['failures']:>10}  {row['check_name']}")
        return 0
    except (ReleaseRejected, QualityGate) as problem:
        print(problem, file=sys.stderr)
        return 1
    finally:
        if spark_is_own:
            discard_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
