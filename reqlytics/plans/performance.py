"""Gold mart: one row per (quarter, issue), with the speed x recurrence group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqlytics.contract import MIN_REQUESTS
from reqlytics.functions.keys import issue_quarter_key
from reqlytics.operators.median import aggregate_with_median
from reqlytics.operators.quadrant import with_quadrant
from reqlytics.plans.fact import PUBLISHED

CELL = ["source_quarter", "issue_key"]


def build_issue_performance(
    fact: DataFrame, dim_issue: DataFrame, min_requests: int = MIN_REQUESTS
) -> DataFrame:
    """The fact is scanned once and shuffled once, already combined.

    Rows collapse to (quarter, issue, closure hours) with every additive measure. That table feeds
    both the sums and the exact median, so a hot issue is spread by its hours, and all later steps
    work on counts. Labels are joined at the mart's grain, not at the fact's.
    """
    eligible = F.coalesce("is_closure_kpi_eligible", F.lit(False))
    status = F.col("status_code")
    hours = (
        fact.withColumn("_hours", F.when(eligible, F.col("closure_hours")))
        .groupBy(*CELL, "_hours")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_repeated").alias("repeated"),
            F.count("is_repeated").alias("flagged"),
            F.count_if(status.isin(PUBLISHED)).alias("published"),
            F.count_if(status == "completed").alias("completed"),
            F.count_if(eligible).alias("eligible"),
        )
    )
    cells = (
        aggregate_with_median(
            hours,
            CELL,
            value="_hours",
            weight="n",
            aggs=[
                F.sum("n").alias("total_requests"),
                F.sum("repeated").alias("repeated_requests"),
                F.sum("flagged").alias("_flagged"),
                F.sum("published").alias("requests_with_status"),
                F.sum("completed").alias("_completed"),
                F.sum("eligible").alias("closure_kpi_requests"),
            ],
            out="median_closure_hours",
        )
        .withColumn("repeat_rate", F.try_divide("repeated_requests", "total_requests"))
        .withColumn("completion_rate", F.try_divide("_completed", "requests_with_status"))
    )
    # an issue the dimension does not know is left out here, before the period limits are taken
    labels = dim_issue.select("issue_key", "issue_ar", "issue_en", "domain_ar", "domain_en")
    named = cells.join(labels, "issue_key")
    grouped = with_quadrant(
        named,
        period="source_quarter",
        size="total_requests",
        speed="median_closure_hours",
        rate="repeat_rate",
        repeated="repeated_requests",
        flagged="_flagged",
        min_size=min_requests,
    )
    return grouped.select(
        issue_quarter_key(F.col("source_quarter"), F.col("issue_key")).alias("issue_quarter_key"),
        "source_quarter", "issue_key", "issue_ar", "issue_en", "domain_ar", "domain_en",
        "total_requests", "repeated_requests", "repeat_rate", "requests_with_status",
        "completion_rate", "closure_kpi_requests", "median_closure_hours",
        "closure_threshold_hours", "repeat_threshold", "resolution_group",
    )
