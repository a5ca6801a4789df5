"""Contiguous runs of equal labels along a row number (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from reqlytics.sources.warehouse import materialise

CHUNK_ROWS = 1 << 20


def label_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    label: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(keys, run, label, first row, last row, rows) for every maximal run of one label.

    ``order`` is a whole number, unique within the keys. A plain window over the keys would put a
    whole file into one task, so rows are cut into chunks of ``chunk_rows`` numbers: runs are found
    inside each chunk, then the chunks' runs (a handful each when labels are contiguous) are joined
    up where a chunk starts with the label the previous one ended with. Only one row per chunk goes
    through a per-key window, so no task ever sorts more than one chunk of rows.
    """
    keys = list(keys)
    rows = df.select(
        *keys,
        F.col(order).cast("long").alias("first_row"),
        F.col(order).cast("long").alias("last_row"),
        F.lit(1).cast("long").alias("n_rows"),
        F.col(label).alias("label"),
    )
    chunk = F.floor(F.col("first_row") / chunk_rows)
    # read twice below and far smaller than the rows, so it is written once
    within = materialise(_merge(rows.withColumn("_c", chunk), [*keys, "_c"]), "runs")

    # Neighbouring chunk: only its last label matters. One row per chunk, so the window is bounded.
    edges = within.groupBy(*keys, "_c").agg(
        F.max_by("label", "first_row").alias("_tail"),
        F.min_by("label", "first_row").alias("_head"),
        F.count(F.lit(1)).alias("_runs"),
    )
    along = Window.partitionBy(*keys).orderBy("_c")
    joined = F.coalesce(F.lag("_tail").over(along).eqNullSafe(F.col("_head")), F.lit(False)) & (
        F.row_number().over(along) > 1
    )
    linked = edges.select(*keys, "_c", "_runs", joined.cast("long").alias("_joined"))
    before = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = linked.select(
        *keys,
        "_c",
        (F.sum(F.col("_runs") - F.col("_joined")).over(before) - F.col("_runs")).alias("_offset"),
    )
    inside = Window.partitionBy(*keys, "_c").orderBy("first_row")
    numbered = within.withColumn("_i", F.row_number().over(inside)).join(offsets, [*keys, "_c"])
    return (
        numbered.withColumn("run", (F.col("_i") + F.col("_offset")).cast("long"))
        .groupBy(*keys, "run", F.col("label").alias(label))  # one label per run: a key, not a text minimum
        .agg(
            F.min("first_row").alias("first_row"),
            F.max("last_row").alias("last_row"),
            F.sum("n_rows").alias("n_rows"),
        )
    )


def _merge(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Collapse neighbours with the same label inside one bounded partition."""
    w = Window.partitionBy(*keys).orderBy("first_row")
    starts = F.when(F.row_number().over(w) == 1, 1).otherwise(
        (~F.lag("label").over(w).eqNullSafe(F.col("label"))).cast("int")
    )
    return (
        rows.withColumn("_start", starts)
        .withColumn("_run", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_run", "label")
        .agg(
            F.min("first_row").alias("first_row"),
            F.max("last_row").alias("last_row"),
            F.sum("n_rows").alias("n_rows"),
        )
        .drop("_run")
    )
