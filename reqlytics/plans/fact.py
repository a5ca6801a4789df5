"""Gold fact and the wide reporting table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqlytics.functions.keys import date_key, location_key
from reqlytics.operators.joins import fit_broadcast, lookup_join
from reqlytics.plans.dimensions import UNMAPPED

PUBLISHED = ["completed", "in_progress"]
FACT_CARRIED = [
    "status_code", "source_quarter", "source_layout", "time_band", "is_repeated", "closure_hours",
    "closure_basis", "is_closure_kpi_eligible", "is_zero_closure", "is_closure_outlier",
]


def build_fact(silver: DataFrame, issue_map: DataFrame) -> DataFrame:
    """One row per request. Many spellings lead to one issue code; an unknown one to UNMAPPED."""
    codes = issue_map.select("issue_type_ar", "issue_code")
    coded = lookup_join(silver, codes, "issue_type_ar", spread_by=F.col("request_sk"))
    return coded.select(
        "request_sk",
        date_key(F.col("received_date")).alias("date_key"),
        F.coalesce("issue_code", F.lit(UNMAPPED)).alias("issue_key"),
        location_key(F.col("location_ar")).alias("location_key"),
        *FACT_CARRIED,
    )


def build_report(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_issue: DataFrame,
    dim_location: DataFrame,
    dim_status: DataFrame,
) -> DataFrame:
    """Fact with dimension labels and ready-made KPI columns, at the fact's grain.

    Joins are inner, as the reporting table promises labels; the reconciliation check compares its
    row count with the fact's.
    """
    lookups = {
        "date_key": dim_date.select("date_key", "date", "year_month"),
        "issue_key": dim_issue.select(
            "issue_key", "issue_code", "issue_ar", "issue_en", "domain_ar", "domain_en"
        ),
        "location_key": dim_location.select(
            "location_key", "location_label_ar", "location_en", "location_type"
        ),
        "status_code": dim_status.select("status_code"),
    }
    wide = fact
    for (key, lookup), small in zip(lookups.items(), fit_broadcast(list(lookups.values()))):
        wide = lookup_join(wide, lookup, key, "inner", F.col("request_sk"), small)
    return wide.select(
        "request_sk",
        "source_quarter",
        F.col("date").alias("received_date"),
        "year_month",
        "issue_code", "issue_ar", "issue_en", "domain_ar", "domain_en",
        "location_label_ar", "location_en", "location_type",
        "status_code", "time_band", "closure_basis",
        F.col("is_repeated").cast("long").alias("is_repeated_int"),
        F.when(F.col("status_code") == "completed", 1).otherwise(0).cast("long").alias("is_completed_int"),
        F.when(F.col("status_code").isin(PUBLISHED), 1).otherwise(0).cast("long").alias("has_published_status"),
        F.when(F.col("is_closure_kpi_eligible"), F.col("closure_hours")).alias("closure_hours_kpi"),
        "is_closure_outlier",
    )
