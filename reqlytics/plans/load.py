"""Release files to Bronze: validated, unchanged, with lineage to the exact sheet row.

A load is a batch: it is written aside, counted while it is written, checked, and published by one entry in the
table's commit log. Until then nothing reads it, so a load that fails leaves its quarter as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from reqlytics.contract import Contract
from reqlytics.operators.joins import lookup_join
from reqlytics.plans.rules import quarantine
from reqlytics.plans.validation import failing_files, failure_message, validate_release
from reqlytics.sources.commits import CommittedTable
from reqlytics.sources.releases import file_fingerprints, map_headers, mapped_rows, read_release
from reqlytics.sources.warehouse import RowCounts, Warehouse, materialise

BRONZE_TABLE = "requests"
MANIFEST = "loads"
#: Folder of the rows that a batch's contract drops, beside the batch itself.
DROPPED = "dropped"

LAYOUT_COUNTS = T.StructType([T.StructField("A", T.LongType()), T.StructField("B", T.LongType())])
MANIFEST_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("batch_id", "source_quarter", "source_file", "file_sha256", "ingested_at", "table_id")]
    + [T.StructField(c, T.LongType()) for c in ("rows_in_file", "rows_loaded")]
    + [
        T.StructField(
            "validation",
            T.StructType(
                [
                    T.StructField("status", T.StringType()),
                    T.StructField("embedded_header_rows", T.LongType()),
                    T.StructField("data_rows", T.LongType()),
                    T.StructField("layout_counts", LAYOUT_COUNTS),
                    T.StructField("warnings", T.ArrayType(T.StringType())),
                ]
            ),
        )
    ]
)
DROPPED_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("source_quarter", "source_file", "file_sha256", "batch_id")]
    + [T.StructField("source_row_number", T.LongType()), T.StructField("rule", T.StringType()), T.StructField("value", T.StringType())]
)


class ReleaseRejected(RuntimeError):
    """A file broke the contract, or not every row arrived: nothing after this may be trusted."""


def bronze_schema(contract: Contract = Contract()) -> T.StructType:
    """All text, but for the row number and the load time."""
    text = [*contract.column_names, "source_file", "source_quarter", "file_sha256", "batch_id"]
    return T.StructType(
        [T.StructField("source_row_number", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField("ingested_at", T.TimestampType())]
    )


def bronze_table(warehouse: Warehouse) -> CommittedTable:
    return CommittedTable(warehouse.spark, warehouse.path("bronze", BRONZE_TABLE), "source_quarter")


def build_bronze(
    rows: DataFrame,
    fingerprints: DataFrame,
    quarter: Column,
    batch_id: str,
    ingested_at: datetime,
    contract: Contract = Contract(),
    *extra: str,
) -> DataFrame:
    """Every row and every value as stored, plus lineage and ``extra`` columns of the file. ``quarter`` may depend on the path."""
    marked = lookup_join(
        rows,
        fingerprints.select("source_path", "source_file", "file_sha256", *extra),
        "source_path",
        "inner",
        F.col("source_row_number"),
    )
    schema = bronze_schema(contract)
    lineage = {
        "source_quarter": quarter,
        "batch_id": F.lit(batch_id),
        "ingested_at": F.lit(ingested_at).cast("timestamp"),
    }
    return marked.select(*[lineage.get(f.name, F.col(f.name)).alias(f.name) for f in schema], *extra)


def load_release(
    warehouse: Warehouse,
    path: str | list[str],
    quarter: str | Column,
    contract: Contract = Contract(),
    gate: Callable[[DataFrame], None] | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Validate, load and record release files; returns the manifest rows of this load.

    One failing file stops the load before anything is written. Loading a quarter again replaces that quarter
    only; a release without any rows empties it. ``gate`` may look at the batch before it is published, and raises
    where it must not be. Whatever fails, the table stays as it was. A job that is repeated with the same
    ``batch_id`` writes the same batch again and has one entry in the log.
    """
    spark, table = warehouse.spark, bronze_table(warehouse)
    release = read_release(spark, path, contract)
    report = materialise(validate_release(release, contract), "validation")
    failed = failing_files(report)
    if not failed.isEmpty():
        raise ReleaseRejected(f"nothing was loaded; {failure_message(failed)}")

    period = quarter if isinstance(quarter, Column) else F.lit(quarter)
    batch_id, now = batch_id or uuid.uuid4().hex[:12], datetime.now(timezone.utc)
    by_path = Window.orderBy("source_path")  # one record per file
    files = file_fingerprints(spark, path).withColumn("file_number", F.row_number().over(by_path) - 1)
    files = files.join(report, "source_path").withColumn("source_quarter", period.cast("string"))
    files = materialise(files, "release_files")
    touched = [r[0] for r in files.select("source_quarter").distinct().collect()]
    if None in touched:
        raise ReleaseRejected("nothing was loaded; a file belongs to no quarter")

    rows = mapped_rows(release, map_headers(release.headers, contract), contract)
    bronze = build_bronze(rows, files, period, batch_id, now, contract, "file_number")
    counts = RowCounts(files.count())
    staged = table.folder(batch_id)
    try:
        watched = counts.watch(bronze, "file_number").drop("file_number")
        watched.write.mode("overwrite").partitionBy("source_quarter").parquet(staged)
        written, per_file = counts.get()
        loaded = spark.createDataFrame(list(per_file.items()), "file_number int, rows_loaded long")
        loaded = files.join(loaded, "file_number", "left").fillna(0, ["rows_loaded"])
        loaded = materialise(loaded, "loaded")
        lost = loaded.where("rows_loaded <> rows_in_file").agg(
            F.count(F.lit(1)).alias("n"), F.min("source_path").alias("first")
        ).first()
        if lost["n"] or written != sum(per_file.values()):
            raise ReleaseRejected(f"{lost['n']} file(s) did not arrive in full, {lost['first']} among them")
        if gate is not None:
            gate(spark.read.schema(bronze_schema(contract)).parquet(staged))
        some = loaded.where("dropped_rows > 0").limit(1).count()
        log = quarantine(bronze, contract) if some else spark.createDataFrame([], DROPPED_SCHEMA)
        log.write.mode("overwrite").partitionBy("source_quarter").parquet(table.folder(batch_id, DROPPED))
        manifest = loaded.select(
            F.lit(batch_id).alias("batch_id"),
            "source_quarter",
            "source_file",
            "file_sha256",
            F.lit(now.isoformat()).alias("ingested_at"),
            F.lit(table.root).alias("table_id"),
            "rows_in_file",
            "rows_loaded",
            F.struct(
                "status",
                "embedded_header_rows",
                "data_rows",
                F.struct(F.col("layout_a").alias("A"), F.col("layout_b").alias("B")).alias("layout_counts"),
                "warnings",
            ).alias("validation"),
        )
        manifest.write.mode("overwrite").json(f"{warehouse.path('manifests', MANIFEST)}/{batch_id}")
    except BaseException:
        table.withdraw(batch_id, "batch", DROPPED)
        raise
    per_quarter = loaded.groupBy("source_quarter").agg(F.sum("rows_loaded").alias("n")).collect()
    table.commit(batch_id, {r["source_quarter"]: r["n"] for r in per_quarter}, now.isoformat())
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{warehouse.path('manifests', MANIFEST)}/{batch_id}")


def read_bronze(warehouse: Warehouse, contract: Contract = Contract()) -> DataFrame:
    """Each quarter from the last load that replaced it."""
    return bronze_table(warehouse).read(bronze_schema(contract))


def read_dropped(warehouse: Warehouse) -> DataFrame:
    """Rows of Bronze that the contract of their load keeps out of Silver, with the rule."""
    return bronze_table(warehouse).read(DROPPED_SCHEMA, DROPPED)


def read_manifest(warehouse: Warehouse) -> DataFrame:
    """A row per file of every load that was published."""
    batches = [e["batch_id"] for e in bronze_table(warehouse).entries()]
    if not batches:
        return warehouse.spark.createDataFrame([], MANIFEST_SCHEMA)
    root = warehouse.path("manifests", MANIFEST)
    return warehouse.spark.read.schema(MANIFEST_SCHEMA).json([f"{root}/{b}" for b in batches])
