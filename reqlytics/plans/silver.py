"""Silver: one typed, flagged row per request. Nothing is removed but what the contract drops: repeated header rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqlytics.contract import OUTLIER_HOURS, Contract
from reqlytics.functions.casts import safe_datetime, safe_double
from reqlytics.functions.keys import request_key
from reqlytics.functions.text import is_swapped, layout_of, squeeze, strip
from reqlytics.plans.rules import dropped

LINEAGE = ["source_file", "source_row_number", "file_sha256", "batch_id", "ingested_at"]


def build_silver(bronze: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Map-only: no shuffle, no Python, one pass over Bronze.

    The meaning of two source columns depends on the row. In layout A the status slot holds the
    status and the closure slot the hours; in layout B, and any other whose slots are swapped, the closure slot
    holds a time band and the status slot the hours. A row of no layout is read like A.
    """
    words = contract.labels
    col = F.col
    # null issue types stay: a missing value is reported by the checks, not silently dropped
    requests = bronze.where(~dropped(contract))
    cleaned = requests.select(
        squeeze(col("issue_type_raw")).alias("issue_type_ar"),
        squeeze(col("location_raw")).alias("location_ar"),
        strip(col("status_slot_raw")).alias("_status_slot"),
        strip(col("closure_slot_raw")).alias("_closure_slot"),
        layout_of(lambda c: strip(col(c)), contract.layouts).alias("source_layout"),
        safe_datetime(strip(col("received_raw"))).alias("received_at"),
        strip(col("repeat_flag_raw")).alias("repeat_flag_ar"),
        "source_quarter",
        *LINEAGE,
    )

    swapped = is_swapped(col("source_layout"), contract.layouts)
    routed = cleaned.withColumn("_is_b", swapped).select(
        "*",
        F.when(~col("_is_b"), col("_status_slot")).alias("status_ar"),
        F.when(col("_is_b"), col("_closure_slot")).alias("time_band"),
        safe_double(
            F.when(col("_is_b"), col("_status_slot")).otherwise(col("_closure_slot"))
        ).alias("closure_hours"),
        F.to_date("received_at").alias("received_date"),
    )

    hours, done = col("closure_hours"), col("status_ar") == words.completed
    real = ~F.isnan(hours)  # NaN sorts above every number in Spark; it must not pass as a long closure
    place = col("location_ar")
    return routed.select(
        request_key(col("file_sha256"), col("source_row_number")).alias("request_sk"),
        "source_quarter",
        "source_layout",
        "issue_type_ar",
        "location_ar",
        ((place == words.municipality) | place.startswith(words.municipality + " ")).alias(
            "is_municipality_level"
        ),
        place.isNull().alias("is_location_missing"),
        "status_ar",
        F.when(done, "completed")
        .when(col("status_ar") == words.in_progress, "in_progress")
        .when(col("_is_b"), "not_published")
        .otherwise("unknown")
        .alias("status_code"),
        "received_at",
        "received_date",
        (col("received_at") != col("received_date").cast("timestamp_ntz")).alias("has_received_time"),
        "time_band",
        "repeat_flag_ar",
        (col("repeat_flag_ar") == words.repeated).alias("is_repeated"),
        "closure_hours",
        F.when(hours.isNotNull() & done, "status_confirmed")
        .when(hours.isNotNull() & col("_is_b"), "closure_value_only")
        .alias("closure_basis"),
        (hours.isNotNull() & real & (hours >= 0) & (col("_is_b") | done)).alias(
            "is_closure_kpi_eligible"
        ),
        F.coalesce(hours == 0, F.lit(False)).alias("is_zero_closure"),
        F.coalesce(real & (hours > OUTLIER_HOURS), F.lit(False)).alias("is_closure_outlier"),
        *LINEAGE,
    )
