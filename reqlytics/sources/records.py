"""Text files as numbered records, where a quoted cell may hold line ends.

A file is read by many tasks, and whether a line begins a record depends on all quotes before it. Each split reports
how many of its lines hold an odd number of quotes; the sum over the splits before, one record per split, tells
whether a split begins inside a cell. Only then are its records counted, and their sum over the splits before gives the row
numbers. Files in which every line has an even number of quotes need no second look, and their lines are not shuffled.
In the others only the lines of records that span several are brought together, one record at a time.

Quotes are taken as RFC 4180 has them: a quoted cell is quoted as a whole, a quote in it is doubled. A file is
``broken`` where a quoted cell has no end, is longer than :data:`LONGEST_RECORD`, or is quoted in part over a line end;
it cannot be cut into rows with certainty, so it is refused rather than guessed at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reqlytics.operators.joins import lookup_join
from reqlytics.sources.warehouse import materialise

#: Characters of a record over several lines, which one task holds. A longer one is an unmatched quote.
LONGEST_RECORD = 1 << 24
SPLIT_SIZE = "spark.sql.files.maxPartitionBytes"


@dataclass(frozen=True)
class Records:
    """``rows`` (source_path, source_row_number, value) and, per broken file, its first ``row`` at fault and ``why``."""

    rows: DataFrame
    broken: DataFrame


def tagged_lines(
    spark: SparkSession, path: str | list[str], chosen, line_end: str | None = None, split_bytes: str | None = None
) -> DataFrame:
    """Lines with the split they were read from, written once: how Spark cuts files depends on the cores at hand, which
    change as executors come and go, and every later step must see the same splits.

    ``split_bytes`` cuts files finer than the session does. There are as many tasks all the same, each with several splits:
    what tasks report to the driver grows with their number.
    """
    reader = spark.read if line_end is None else spark.read.option("lineSep", line_end)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    text = reader.text(path)
    lines = text.where(chosen).select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        (quotes % 2).cast("byte").alias("_odd"),
        "value",
    )
    if split_bytes is None:
        return materialise(lines, "lines")
    tasks, size = text.rdd.getNumPartitions(), spark.conf.get(SPLIT_SIZE)
    spark.conf.set(SPLIT_SIZE, split_bytes)
    try:
        return materialise(lines.coalesce(max(tasks, 1)), "lines")
    finally:
        spark.conf.set(SPLIT_SIZE, size)


def _before(column: str):
    """Sum over the splits of the file before this one."""
    earlier = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def split_summary(lines: DataFrame) -> DataFrame:
    """One row per split: lines before it, whether it begins inside a quoted cell, whether its file has such cells."""
    splits = lines.groupBy("source_path", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"), F.sum("_odd").alias("_odds")
    )
    whole = Window.partitionBy("source_path")
    return splits.select(
        "source_path",
        "_block",
        "_first",
        _before("_lines").alias("_base"),
        (_before("_odds") % 2).alias("_inside"),
        (F.sum("_odds").over(whole) > 0).alias("_spans"),
        (F.sum("_odds").over(whole) % 2 == 1).alias("_unclosed"),
    )


def plain_numbers(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Every line is a row: its place in its split and the lines of the splits before. Nothing is shuffled or sorted."""
    placed = lookup_join(lines, splits.select("source_path", "_block", "_first", "_base"), ["source_path", "_block"], "inner", F.col("_id"))
    return placed.select(
        "source_path", (F.col("_id") - F.col("_first") + F.col("_base") + 1).alias("source_row_number"), "value"
    )


def read_records(
    spark: SparkSession, path: str | list[str], chosen, longest: int = LONGEST_RECORD, split_bytes: str | None = None
) -> Records:
    """Records of all text files that meet the condition ``chosen`` on their metadata."""
    lines = tagged_lines(spark, path, chosen, split_bytes=split_bytes)
    splits = materialise(split_summary(lines), "splits")
    plain = plain_numbers(lines, splits.where("NOT _spans"))
    spanning = splits.where("_spans")
    if spanning.isEmpty():
        none = spark.createDataFrame([], "source_path string, row long, why string")
        return Records(plain, none)

    # lines of a split in order: which of them begin a record, and the how manieth of the split
    inner = spanning.select("source_path", "_block", "_inside")
    marked = lookup_join(lines, inner, ["source_path", "_block"], "inner", F.col("_id"))
    order = Window.partitionBy("source_path", "_block").orderBy("_id")
    quotes = F.coalesce(F.sum("_odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = marked.withColumn("_starts", F.when((quotes + F.col("_inside")) % 2 == 0, 1).otherwise(0))
    marked = marked.withColumn("_nth", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    marked = materialise(marked.drop("_inside"), "marked")
    starts = marked.groupBy("source_path", "_block").agg(F.sum("_starts").alias("_starts"))
    bases = materialise(starts.select("source_path", "_block", _before("_starts").alias("_base")), "split_rows")
    numbered = lookup_join(marked, bases, ["source_path", "_block"], "inner", F.col("_id")).select(
        "source_path", (F.col("_nth") + F.col("_base")).alias("source_row_number"), "_id", "_starts", "_odd", "value"
    )
    alone = (F.col("_starts") == 1) & (F.col("_odd") == 0)
    pieces = numbered.where(~alone)
    key = ["source_path", "source_row_number"]
    sizes = pieces.groupBy(*key).agg(F.sum(F.length("value") + 1).alias("chars"))
    open_files = spanning.where("_unclosed").select("source_path").distinct()
    last = sizes.join(open_files, "source_path").groupBy("source_path").agg(F.max("source_row_number").alias("row"))
    unclosed = last.withColumn("why", F.format_string("a quoted cell that begins in row %d has no end", F.col("row")))
    too_long = sizes.where(F.col("chars") > longest).groupBy("source_path").agg(F.min("source_row_number").alias("row"))
    too_long = too_long.withColumn("why", F.format_string("a record is longer than %d characters: row %d", F.lit(longest), F.col("row")))
    bad = materialise(unclosed.unionByName(too_long), "unreadable")

    # only records of files that end well and of bounded length are put together
    whole = lookup_join(pieces, bad.select("source_path").distinct().withColumn("bad", F.lit(True)), "source_path", "left", F.col("_id"))
    joined = whole.where("bad IS NULL").groupBy(*key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_id", "value"))), lambda line: line["value"]), "\n"
        ).alias("value")
    )
    joined = materialise(joined, "joined")
    cells = F.regexp_replace("value", '"[^"]*"', "\u0000")
    partly = joined.where(cells.rlike("[^,\u0000]\u0000|\u0000[^,\u0000]")).groupBy("source_path")
    partly = partly.agg(F.min("source_row_number").alias("row")).withColumn(
        "why", F.format_string("quoted text that goes on over a line end is only a part of its cell: row %d", F.col("row"))
    )
    broken = bad.unionByName(partly).groupBy("source_path").agg(F.min(F.struct("row", "why")).alias("first"))
    rows = plain.unionByName(numbered.where(alone).select(*key, "value")).unionByName(joined.select(*key, "value"))
    return Records(rows, broken.select("source_path", "first.row", "first.why"))
