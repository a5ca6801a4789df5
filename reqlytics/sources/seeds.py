"""Version-controlled lookups: CSV files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of the lookups, all text.
ISSUE_MAP_COLUMNS = [
    "issue_type_ar", "issue_code", "issue_ar", "issue_en", "department_ar",
    "department_en", "domain_ar", "domain_en", "translation_source",
]
LOCATION_MAP_COLUMNS = [
    "location_ar", "location_label_ar", "location_en",
    "location_type", "location_type_ar", "location_type_en",
]


def read_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)  # a header in another order is an error, not a silent swap
        .csv(path)
    )


def read_issue_map(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, ISSUE_MAP_COLUMNS)


def read_location_map(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, LOCATION_MAP_COLUMNS)


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Optional lookup ``location_label, lat, lon``: the output of a geocoding step run elsewhere."""
    return (
        spark.read.schema("location_label STRING, lat DOUBLE, lon DOUBLE")
        .option("header", True).option("enforceSchema", False).csv(path)
    )
