"""Contract validation: one report row per release file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reqlytics.contract import DROP, FAIL, WARN, Contract
from reqlytics.functions.text import is_header_text, is_swapped, layout_of, strip
from reqlytics.plans.rules import row_rules
from reqlytics.sources.releases import Release, map_headers, mapped_rows, read_release
from reqlytics.sources.warehouse import materialise

EXAMPLES = 5


def structure_report(release: Release, contract: Contract = Contract()) -> DataFrame:
    """Checks of every input file's shape; ``errors`` is empty where rows may be looked at.

    A file that cannot be read in full is an error whatever the contract says: one without a header row, and
    one whose quoted cells do not end, so that it cannot be cut into rows.
    """
    # one row per file
    placed = release.shapes.join(map_headers(release.headers, contract), "source_path", "left")
    has_header = F.col("headers").isNotNull()
    count = F.greatest(F.size("headers"), F.coalesce("widest", F.lit(0)))
    unreadable = F.array_compact(
        F.array(
            F.when(~has_header, F.format_string("no header row: it is expected in row %d", F.lit(contract.header_row + 1))),
            F.col("broken"),
        )
    )
    problems = [
        (
            "column_count_mismatch",
            has_header & (count != contract.expected_columns),
            F.format_string(f"found %d columns, expected {contract.expected_columns}", count),
        ),
        (
            "missing_required_column",
            has_header & (F.size("missing") > 0),
            F.concat(F.lit("required columns not found: "), F.array_join("missing", ", ")),
        ),
        (
            "unexpected_column",
            has_header & (F.size("unexpected") > 0),
            F.concat(F.lit("columns not in the contract, not loaded: "), F.array_join("unexpected", ", ")),
        ),
    ]
    return placed.select(
        "source_path",
        "headers",
        "positions",
        F.concat(unreadable, _messages(problems, contract, FAIL)).alias("errors"),
        _messages(problems, contract, WARN).alias("warnings"),
    )


def _messages(problems: list[tuple[str, Column, Column]], contract: Contract, level: str) -> Column:
    chosen = [F.when(hit, text) for rule, hit, text in problems if contract.rules.get(rule) == level]
    if not chosen:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*chosen))


def row_profile(rows: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """One pass over the rows: (file, kind of row, offending values) with counts and first rows.

    Clean data collapses to a few records per file before any shuffle; offending values are part of
    the key, so even a file full of different ones is spread over tasks.
    """
    names = contract.column_names
    cells = rows.select("source_path", "source_row_number", *[strip(F.col(c)).alias(c) for c in names])
    embedded = F.coalesce(F.col("issue_type_raw").isin(contract.issue_headers), F.lit(False))
    empty = F.coalesce(*names).isNull()
    layout = layout_of(F.col, contract.layouts)
    rules = {r.name: r for r in row_rules(contract, F.col, embedded)}
    # what is dropped is what Silver leaves out: headers however they are spaced
    as_silver = row_rules(contract, F.col, is_header_text(F.col("issue_type_raw"), contract.issue_headers))
    drops = [r.broken for r in as_silver if contract.rules.get(r.name) == DROP]

    def offence(rule: str, name: str) -> list[Column]:
        broken, value = rules[rule].broken, rules[rule].value
        return [broken.alias(f"is_bad_{name}"), F.when(broken, value).alias(f"bad_{name}")]

    tagged = cells.select(
        "source_path",
        "source_row_number",
        embedded.alias("is_embedded"),
        empty.alias("is_empty"),
        (~embedded & ~empty).alias("is_data"),
        layout.alias("layout"),
        is_swapped(layout, contract.layouts).alias("is_swapped"),
        *offence("unknown_status", "status"),
        *offence("unknown_repeat_flag", "flag"),
        *offence("unknown_time_band", "band"),
        reduce(lambda a, b: a | b, drops, F.lit(False)).alias("is_dropped"),
    )
    kinds = [c for c in tagged.columns if c != "source_row_number"]
    return tagged.groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"), F.min("source_row_number").alias("first_row"))


def _first_seen(profile: DataFrame, hit: str, value: str, out: str) -> DataFrame:
    """Up to five distinct offending values per file, in order of first appearance."""
    order = Window.partitionBy("source_path").orderBy("first_row")
    return (
        profile.where(hit)
        .groupBy("source_path", value)
        .agg(F.min("first_row").alias("first_row"))
        .withColumn("i", F.row_number().over(order))
        .where(F.col("i") <= EXAMPLES)
        .groupBy("source_path")
        .agg(F.array_sort(F.collect_list(F.struct("i", F.col(value).alias("v")))).alias("s"))
        .select("source_path", F.transform("s", lambda x: x["v"]).alias(out))
    )


def row_report(profile: DataFrame) -> DataFrame:
    """Counts and examples per file, from the collapsed profile."""
    def total(condition: str) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0))

    counts = profile.groupBy("source_path").agg(
        F.sum("n").alias("rows_in_file"),
        total("is_embedded").alias("embedded_header_rows"),
        total("is_empty").alias("empty_rows"),
        total("is_data").alias("data_rows"),
        total("is_data AND layout IS NOT NULL AND NOT is_swapped").alias("layout_a"),
        total("is_data AND is_swapped").alias("layout_b"),
        total("is_data AND layout IS NULL").alias("unknown_layout_rows"),
        total("is_bad_status").alias("invalid_status_in_layout_a"),
        total("is_bad_flag").alias("invalid_repeat_flag"),
        total("is_bad_band").alias("invalid_time_band"),
        total("is_dropped").alias("dropped_rows"),
    )
    statuses = _first_seen(profile, "is_bad_status", "bad_status", "status_examples")
    flags = _first_seen(profile, "is_bad_flag", "bad_flag", "repeat_flag_examples")
    bands = _first_seen(profile, "is_bad_band", "bad_band", "time_band_examples")
    return reduce(lambda found, seen: found.join(seen, "source_path", "left"), [statuses, flags, bands], counts)


COUNTS = [
    "rows_in_file", "embedded_header_rows", "empty_rows", "data_rows", "layout_a", "layout_b",
    "unknown_layout_rows", "invalid_status_in_layout_a", "invalid_repeat_flag", "invalid_time_band", "dropped_rows",
]


def full_report(structure: DataFrame, rows: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Join both parts. A file with structural errors has no row figures: its rows were not read."""
    sound = F.size("errors") == 0
    joined = structure.join(rows, "source_path", "left").select(
        "*", *[F.when(sound, F.coalesce(c, F.lit(0))).alias(f"_{c}") for c in COUNTS]
    )

    def shown(values: str) -> Column:
        return F.array_join(F.col(values), ", ", "null")

    problems = [
        (
            "embedded_header_row",
            F.col("_embedded_header_rows") > 0,
            F.format_string("%d rows that repeat the header", F.col("_embedded_header_rows")),
        ),
        (
            "unknown_layout_row",
            F.col("_unknown_layout_rows") > 0,
            F.format_string("%d rows that match no layout", F.col("_unknown_layout_rows")),
        ),
        (
            "unknown_status",
            F.col("_invalid_status_in_layout_a") > 0,
            F.format_string(
                "%d layout-A rows with a status outside the contract: %s",
                F.col("_invalid_status_in_layout_a"), shown("status_examples"),
            ),
        ),
        (
            "unknown_repeat_flag",
            F.col("_invalid_repeat_flag") > 0,
            F.format_string(
                "%d rows with a repeat flag outside the contract: %s",
                F.col("_invalid_repeat_flag"), shown("repeat_flag_examples"),
            ),
        ),
        (
            "unknown_time_band",
            F.col("_invalid_time_band") > 0,
            F.format_string(
                "%d rows with a time band outside the contract: %s", F.col("_invalid_time_band"), shown("time_band_examples")
            ),
        ),
    ]
    judged = joined.select(
        "*",
        F.concat("errors", _messages(problems, contract, FAIL)).alias("_errors"),
        F.concat("warnings", _messages(problems, contract, WARN)).alias("_warnings"),
    )
    return judged.select(
        "source_path",
        F.when(F.size("_errors") > 0, "fail")
        .when(F.size("_warnings") > 0, "pass_with_warnings")
        .otherwise("pass")
        .alias("status"),
        F.col("_errors").alias("errors"),
        F.col("_warnings").alias("warnings"),
        F.col("headers").alias("headers_found"),
        *[F.col(f"_{c}").alias(c) for c in COUNTS],
        "status_examples",
        "repeat_flag_examples",
        "time_band_examples",
    )


def validate_release(release: Release, contract: Contract = Contract()) -> DataFrame:
    """Report per file. Rows are read once, and only those of structurally sound files."""
    structure = materialise(structure_report(release, contract), "structure")
    sound = structure.where(F.size("errors") == 0)
    profile = materialise(row_profile(mapped_rows(release, sound, contract), contract), "row_profile")
    return full_report(structure, row_report(profile), contract)


def validate_files(spark: SparkSession, path: str | list[str], contract: Contract = Contract()) -> DataFrame:
    return validate_release(read_release(spark, path, contract), contract)


def failing_files(report: DataFrame) -> DataFrame:
    """``source_path`` and ``errors`` of the files that fail, all of them."""
    return report.where("status = 'fail'").select("source_path", "errors")


def failure_message(failing: DataFrame, named: int = 20) -> str:
    """How many files fail, and the first few by name; the report holds them all."""
    first = [r["source_path"] for r in failing.select("source_path").orderBy("source_path").limit(named).collect()]
    total = failing.count()
    return f"{total} failing file(s): {', '.join(first)}" + (f" and {total - len(first)} more" if total > len(first) else "")
