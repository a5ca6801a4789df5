"""Release files as rows of text cells with their sheet row numbers.

Two formats give the same frame ``(source_path, source_row_number, cells)``: delimited text, which
Spark splits over many tasks, and workbooks, which are decoded one file per task (the format bounds
a sheet to about a million rows). Row numbers are 1-based and count every record, blank ones too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reqlytics.contract import Contract
from reqlytics.functions.text import strip
from reqlytics.operators.joins import lookup_join
from reqlytics.sources import workbook
from reqlytics.sources.records import plain_numbers, read_records, split_summary, tagged_lines
from reqlytics.sources.warehouse import materialise

COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
MAX_HASHED_BYTES = 256 << 20


@dataclass(frozen=True)
class Release:
    """Rows after the header row, and a header record of each file that has one.

    ``shapes`` has a row for every input file, read or not: cells of its widest row, and why it cannot be cut into
    rows (``broken``; null: it can).
    """

    rows: DataFrame
    headers: DataFrame
    shapes: DataFrame


def is_workbook(path: Column) -> Column:
    return F.lower(path).endswith(".xlsx")


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(source_path, is_book)`` of every input file; no content is read."""
    listing = spark.read.format("binaryFile").load(path)
    found = listing.select(F.col("_metadata.file_path").alias("source_path"))
    # a scan leaves out files of no bytes; Spark's own listing, which the driver holds anyway, has them
    listed = spark.createDataFrame([(f,) for f in listing.inputFiles()], "f string").select(
        F.regexp_replace("f", "^file:/+", "file:/").alias("source_path")  # as the metadata column writes it
    )
    empty = listed.join(found, "source_path", "left_anti")
    return found.unionByName(empty).withColumn("is_book", is_workbook(F.col("source_path")))


def numbered_lines(
    spark: SparkSession, path: str | list[str], larger_than: int = -1, line_end: str | None = None
) -> DataFrame:
    """``(source_path, source_row_number, value)`` of text files line by line, whatever the splits."""
    size = F.col("_metadata.file_size")
    lines = tagged_lines(spark, path, ~is_workbook(F.col("_metadata.file_name")) & (size > larger_than), line_end)
    return plain_numbers(lines, materialise(split_summary(lines), "splits"))


def _header_cells(line: Column) -> Column:
    """Header texts: commas inside quotes do not separate, doubled quotes are one quote."""
    parts = F.split(line, COMMA_OUTSIDE_QUOTES, -1)
    return F.transform(
        parts, lambda h: F.replace(F.btrim(strip(h), F.lit('"')), F.lit('""'), F.lit('"'))
    )


def _cells(value: Column, width: int) -> Column:
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    record = F.from_csv(value, F.lit(schema), {"escape": '"', "mode": "PERMISSIVE"})
    return F.array(*[record.getField(f"c{i}") for i in range(width)])


def read_text_release(
    spark: SparkSession, path: str, contract: Contract = Contract(), split_bytes: str | None = None
) -> Release:
    """Records of all text files; a row number counts records, so a cell with line ends takes one, as in a sheet."""
    records = read_records(spark, path, ~is_workbook(F.col("_metadata.file_name")), split_bytes=split_bytes)
    lines = records.rows
    header_number = contract.header_row + 1
    headers = materialise(
        lines.where(F.col("source_row_number") == header_number).select(
            "source_path", _header_cells(F.col("value")).alias("headers")
        ),
        "headers",
    )
    width = headers.agg(F.max(F.size("headers"))).first()[0] or 1
    body = lines.where(F.col("source_row_number") > header_number).select(
        "source_path", "source_row_number", _cells(F.col("value"), width).alias("cells")
    )
    unquoted = F.regexp_replace("value", '"[^"]*"', "q")
    filled = F.regexp_replace(unquoted, r"[,\s]+$", "")
    commas = F.length(filled) - F.length(F.replace(filled, F.lit(",")))
    widest = lines.groupBy("source_path").agg(
        F.max(F.when(F.col("source_row_number") >= header_number, commas + 1)).alias("widest")
    )
    shapes = widest.join(records.broken.select("source_path", F.col("why").alias("broken")), "source_path", "full")
    return Release(body, headers, shapes)


def read_workbook_release(spark: SparkSession, path: str, contract: Contract = Contract()) -> Release:
    """First sheet of every workbook below a path."""
    files = (
        spark.read.format("binaryFile")
        .load(path)
        .where(is_workbook(F.col("_metadata.file_name")))
        .select(F.col("_metadata.file_path").alias("path"), "content")
    )
    return workbook_release(files, contract)


def workbook_release(files: DataFrame, contract: Contract = Contract()) -> Release:
    """First sheet of every workbook of ``(path, content)``, all cells as text, decoded once and written as rows."""
    cloudpickle.register_pickle_by_value(workbook)  # executors need not have this package installed
    decoded = files.repartition("path").mapInPandas(
        workbook.decode, "source_path STRING, source_row_number LONG, cells ARRAY<STRING>"
    )
    rows = materialise(decoded, "workbook_rows")
    header_number = contract.header_row + 1
    headers = rows.where(F.col("source_row_number") == header_number).select(
        "source_path", F.transform("cells", lambda c: F.coalesce(strip(c), F.lit(""))).alias("headers")
    )
    filled = F.transform("cells", lambda c, i: F.when(F.length(strip(c)) > 0, i + 1))
    shapes = rows.where(F.col("source_row_number") >= header_number).groupBy("source_path").agg(
        F.max(F.array_max(filled)).alias("widest"), F.lit(None).cast("string").alias("broken")
    )
    return Release(rows.where(F.col("source_row_number") > header_number), headers, shapes)


def read_release(
    spark: SparkSession, path: str | list[str], contract: Contract = Contract(), split_bytes: str | None = None
) -> Release:
    """Files of either format, told apart one by one by their ending, in any letter case.

    Files that have no rows, or too few for a header, are in ``shapes`` all the same. Text is cut into splits of
    ``split_bytes``, or of the session's size.
    """
    files = materialise(listed_files(spark, path), "files")
    kinds = {r["is_book"] for r in files.select("is_book").distinct().collect()}
    parts = []
    if False in kinds:
        parts.append(read_text_release(spark, path, contract, split_bytes))
    if True in kinds:
        parts.append(read_workbook_release(spark, path, contract))
    rows, headers, shapes = (
        reduce(DataFrame.unionByName, [getattr(p, name) for p in parts]) for name in ("rows", "headers", "shapes")
    )
    return Release(rows, headers, files.select("source_path").join(shapes, "source_path", "left"))


# ---------------------------------------------------------------- headers
def map_headers(headers: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Per file: where each contract column sits (0: nowhere), what is missing, what is unexpected."""
    known = [alias for c in contract.columns for alias in c.aliases]
    found = F.col("headers")

    def position(aliases: tuple[str, ...]) -> Column:
        hits = F.transform(found, lambda h: F.coalesce(h.isin(list(aliases)), F.lit(False)))
        return F.array_position(hits, True).cast("int")

    placed = headers.select(
        "source_path",
        "headers",
        F.struct(*[position(c.aliases).alias(c.name) for c in contract.columns]).alias("positions"),
        F.filter(found, lambda h: ~F.coalesce(h.isin(known), F.lit(False))).alias("unexpected"),
    )
    absent = [
        F.when(F.col(f"positions.{c.name}") == 0, F.lit(c.name)) for c in contract.columns if c.required
    ]
    return placed.withColumn("missing", F.array_compact(F.array(*absent)))


def mapped_rows(release: Release, placed: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Contract columns of every row exactly as stored; cells that mean 'empty' become null."""
    joined = lookup_join(
        release.rows,
        placed.select("source_path", "positions"),
        "source_path",
        "inner",
        F.col("source_row_number"),
    )

    def cell(name: str) -> Column:
        at = F.col(f"positions.{name}")
        value = F.when(at > 0, F.get(F.col("cells"), at - 1))
        return F.when(~value.isin(list(contract.null_tokens)), value).alias(name)

    return joined.select("source_path", "source_row_number", *[cell(c) for c in contract.column_names])


# ---------------------------------------------------------------- fingerprints
def file_fingerprints(spark: SparkSession, path: str, max_bytes: int = MAX_HASHED_BYTES) -> DataFrame:
    """``(source_path, source_file, file_sha256, n_bytes)``: same content, same fingerprint.

    SHA-256 is sequential, so a file is hashed by one task; that is right for files up to
    ``max_bytes`` and for workbooks. Larger text files have a digest tree over their lines, cut at line feeds
    only, so carriage returns count, and their size, so a missing last line end counts. It begins with
    ``tree-`` and is never taken for the hash of the bytes. Which way is taken depends on the file alone.
    """
    files = spark.read.format("binaryFile").load(path)
    source = F.col("_metadata.file_path")
    is_large = (F.col("length") > max_bytes) & ~is_workbook(source)
    whole = files.where(~is_large).select(
        source.alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.sha2("content", 256).alias("file_sha256"),
        F.col("length").alias("n_bytes"),
    )
    large = files.where(is_large).select(source.alias("source_path"), F.col("length").alias("size"))
    if large.isEmpty():
        return whole
    trees = line_fingerprints(numbered_lines(spark, path, max_bytes, "\n")).join(large, "source_path")
    root = F.sha2(F.concat_ws(":", "file_sha256", "size"), 256)
    return whole.unionByName(
        trees.select("source_path", "source_file", F.concat(F.lit("tree-"), root).alias("file_sha256"), F.col("size").alias("n_bytes"))
    )


def line_fingerprints(lines: DataFrame, fan_in: int = 4096) -> DataFrame:
    """Fingerprint of a text file of any size: a tree of SHA-256 digests over its numbered lines.

    Every node digests at most ``fan_in`` children, so no task holds more than that.
    """
    level = lines.select(
        "source_path",
        (F.col("source_row_number") - 1).alias("i"),
        F.sha2(F.coalesce("value", F.lit("")), 256).alias("d"),
        (F.octet_length("value") + 1).cast("long").alias("n_bytes"),
    )
    while True:
        parent = F.floor(F.col("i") / fan_in).cast("long")
        level = materialise(
            level.groupBy("source_path", parent.alias("i")).agg(
                F.sha2(
                    F.array_join(
                        F.transform(F.array_sort(F.collect_list(F.struct("i", "d"))), lambda x: x["d"]), ""
                    ),
                    256,
                ).alias("d"),
                F.sum("n_bytes").alias("n_bytes"),
            ),
            "digests",
        )
        if (level.agg(F.max("i")).first()[0] or 0) == 0:
            break
    return level.select(
        "source_path",
        F.substring_index("source_path", "/", -1).alias("source_file"),
        F.col("d").alias("file_sha256"),
        "n_bytes",
    )
