"""Profiles that show how a source behaves: layout runs and what a slot really holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqlytics.contract import Contract
from reqlytics.functions.casts import safe_double
from reqlytics.functions.text import is_header_text, layout_of, strip
from reqlytics.operators.median import aggregate_with_median
from reqlytics.operators.runs import label_runs


def with_layout(bronze: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Bronze requests (repeated header rows left out) with their layout."""
    header = is_header_text(F.col("issue_type_raw"), contract.issue_headers)
    return bronze.where(~header).withColumn("source_layout", layout_of(lambda c: strip(F.col(c)), contract.layouts))


def layout_runs(bronze: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Contiguous runs of each layout by sheet row, per file."""
    rows = with_layout(bronze, contract).select("source_file", "source_row_number", "source_layout")
    return label_runs(rows, ["source_file"], "source_row_number", "source_layout")


def slot_profile(bronze: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Per layout and slot: how many cells are filled, how many are numbers, and their median.

    A slot that turns numeric under the other layout shows that its content was swapped.
    """
    slots = with_layout(bronze, contract).select(
        "source_layout",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("slot"), strip(F.col(c)).alias("cell"))
                    for c in ("status_slot_raw", "closure_slot_raw")
                ]
            )
        ),
    )
    counts = (
        slots.withColumn("_value", safe_double(F.col("cell")))
        .groupBy("source_layout", "slot", "_value")
        .agg(F.count(F.lit(1)).alias("n"), F.count("cell").alias("filled"))
    )
    result = aggregate_with_median(
        counts,
        ["source_layout", "slot"],
        "_value",
        "n",
        [
            F.sum("n").alias("cells"),
            F.sum("filled").alias("filled"),
            F.coalesce(F.sum(F.when(F.col("_value").isNotNull(), F.col("n"))), F.lit(0)).alias("numeric"),
        ],
        "median_value",
    )
    return result.withColumn("numeric_share", F.try_divide("numeric", "filled"))
