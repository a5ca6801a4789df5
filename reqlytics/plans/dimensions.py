"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reqlytics.contract import Contract
from reqlytics.functions.keys import date_key, location_key
from reqlytics.operators.joins import lookup_join

UNMAPPED = "UNMAPPED"


def silver_places(silver: DataFrame) -> DataFrame:
    """All that the dimensions take from Silver, per quarter: a few rows for each place, with its first and last date."""
    return silver.groupBy("source_quarter", "location_ar", "is_municipality_level", "is_location_missing").agg(
        F.min("received_date").alias("first_date"), F.max("received_date").alias("last_date")
    )


def build_dim_date(silver: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last received date; empty without any date."""
    span = silver.agg(F.min("received_date").alias("first"), F.max("received_date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").cast("long").alias("year"),
        F.quarter("date").cast("long").alias("quarter"),
        F.date_format("date", "yyyy-'Q'q").alias("year_quarter"),
        F.month("date").cast("long").alias("month"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        F.date_format("date", "MMMM").alias("month_name_en"),
        F.weekofyear("date").cast("long").alias("iso_week"),
        F.date_format("date", "EEEE").alias("day_name_en"),
    )


def build_dim_issue(issue_map: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Canonical issues plus the member that catches every spelling the map does not know."""
    canonical = issue_map.select(
        F.col("issue_code").alias("issue_key"),
        *[c for c in issue_map.columns if c != "issue_type_ar"],
    ).distinct()
    text = contract.labels.unmapped
    member = [UNMAPPED, UNMAPPED, text, "Unmapped", text, "Unmapped", text, "Unmapped", "none"]
    values = [F.lit(v).alias(c) for v, c in zip(member, canonical.columns)]
    return canonical.unionByName(issue_map.sparkSession.range(1).select(*values))


def build_dim_location(
    silver: DataFrame, location_map: DataFrame, contract: Contract = Contract()
) -> DataFrame:
    """One row per location text. Silver collapses to its distinct places before hash and join."""
    missing = F.lit(contract.labels.location_missing)
    places = silver.select("location_ar", "is_municipality_level", "is_location_missing").distinct()
    keyed = places.select(
        location_key(F.col("location_ar")).alias("location_key"),
        F.coalesce("location_ar", missing).alias("location_ar"),
        F.coalesce("is_municipality_level", F.lit(False)).alias("is_municipality_level"),
        "is_location_missing",
    )
    named = lookup_join(keyed, location_map, "location_ar", spread_by=F.col("location_key"))
    return named.select(
        "location_key",
        "location_ar",
        F.coalesce("location_label_ar", "location_ar").alias("location_label_ar"),
        F.coalesce("location_en", F.lit("Not mapped")).alias("location_en"),
        F.coalesce("location_type", F.lit("unmapped")).alias("location_type"),
        "location_type_ar",
        "location_type_en",
        "is_municipality_level",
        "is_location_missing",
    )


def build_dim_status(spark: SparkSession, contract: Contract = Contract()) -> DataFrame:
    words = contract.labels
    members = [
        ("completed", words.completed, "Completed", True),
        ("in_progress", words.in_progress, "In progress", True),
        ("not_published", words.not_published, "Not published", False),
    ]
    names = ["status_code", "status_label_ar", "status_label_en", "is_status_published"]
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(member, names)]) for member in members]
    return spark.range(1).select(F.inline(F.array(*rows)))
