"""Data-quality checks with severities, run per layer, that gate the next layer.

A check is data: what it looks at and how many failures it tolerates. All row-level checks of a
table share one aggregation over it; key checks count hashes of keys first, combined before the shuffle, and look at
the keys themselves only where a hash repeats. A suite returns one row per declared check, and the number of rows is
itself checked, because a check that silently did not run looks like a pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from reqlytics.contract import Contract
from reqlytics.functions.labels import GROUPS
from reqlytics.operators.joins import fits_broadcast
from reqlytics.plans.rules import dropped
from reqlytics.sources.warehouse import materialise

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """``failures`` above ``warn_above`` warn and above ``error_above`` stop (None: never)."""

    name: str
    table: str
    kind: str
    column: str = ""
    values: tuple[str, ...] = ()
    parent: str = ""
    warn_above: int = 0
    error_above: int | None = 0

    @property
    def severity(self) -> str:
        return WARN if self.error_above is None else ERROR


@dataclass(frozen=True)
class Tables:
    """The frames a suite looks at, by name."""

    frames: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]


# ---------------------------------------------------------------- declaring checks
def unique(table: str, column: str) -> Check:
    return Check(f"unique_{table}_{column}", table, "unique", column)


def not_null(table: str, column: str, warn_above: int = 0, error_above: int | None = 0) -> Check:
    return Check(
        f"not_null_{table}_{column}", table, "not_null", column,
        warn_above=warn_above, error_above=error_above,
    )


def key(table: str, column: str) -> list[Check]:
    return [unique(table, column), not_null(table, column)]


def accepted(table: str, column: str, values: Sequence[str]) -> Check:
    return Check(f"accepted_{table}_{column}", table, "accepted", column, tuple(values))


def reference(table: str, column: str, parent: str) -> Check:
    return Check(f"reference_{table}_{column}", table, "reference", column, parent=parent)


# ---------------------------------------------------------------- rows that break a rule
# A missing date is not judged by the quarter rule; NaN hours are not negative.
ROW_RULES = {
    "closure_hours_negative": "NOT isnan(closure_hours) AND closure_hours < 0",
    "received_outside_quarter": "concat(year(received_date), 'Q', quarter(received_date)) <> source_quarter",
    "time_band_against_layout": (
        "(source_layout = 'B' AND time_band IS NULL) OR (source_layout = 'A' AND time_band IS NOT NULL)"
    ),
}


def unmapped(child: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Distinct values the lookup does not know. Values are counted before they are joined, so the
    join sees each value once and no key is hot.

    A missing issue type has no match either and is reported; callers drop nulls where a missing
    value is legitimate.
    """
    values = child.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return values.join(lookup.select(column), column, "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows behind each."""
    return unmapped(child.where(F.col(column).isNotNull()), column, parent)


def unmapped_issues(silver: DataFrame, issue_map: DataFrame) -> DataFrame:
    return unmapped(silver, "issue_type_ar", issue_map)


def unmapped_locations(silver: DataFrame, location_map: DataFrame) -> DataFrame:
    return unmapped(silver.where("location_ar IS NOT NULL"), "location_ar", location_map)


def failing_rows(silver: DataFrame, rule: str) -> DataFrame:
    """The requests behind a row rule."""
    return silver.where(ROW_RULES[rule]).select(
        "request_sk", "source_quarter", "source_layout", "time_band", "received_date", "closure_hours"
    )


# ---------------------------------------------------------------- the declared suite
def silver_checks(contract: Contract = Contract()) -> list[Check]:
    t = "silver"
    return [
        *key(t, "request_sk"),
        accepted(t, "source_layout", ["A", "B"]),
        not_null(t, "status_code"),
        accepted(t, "status_code", ["completed", "in_progress", "not_published"]),
        not_null(t, "repeat_flag_ar"),
        accepted(t, "repeat_flag_ar", contract.repeat_flags),
        accepted(t, "time_band", contract.time_bands),
        not_null(t, "issue_type_ar"),
        not_null(t, "location_ar", warn_above=0, error_above=100),
        not_null(t, "received_date"),
        Check("closure_hours_negative", t, "row_rule"),
        Check("received_outside_quarter", t, "row_rule"),
        Check("time_band_against_layout", t, "row_rule"),
        Check("silver_reconciles_with_bronze", t, "reconcile"),
        Check("issue_types_unmapped", t, "unmapped", "issue_type_ar", parent="issue_map", error_above=None),
        Check("locations_unmapped", t, "unmapped", "location_ar", parent="location_map", error_above=None),
    ]


def seed_checks() -> list[Check]:
    return [
        *key("issue_map", "issue_type_ar"),
        not_null("issue_map", "issue_code"),
        not_null("issue_map", "issue_en"),
        *key("location_map", "location_ar"),
        not_null("location_map", "location_en"),
    ]


def dimension_checks() -> list[Check]:
    return [
        *key("dim_date", "date_key"),
        *key("dim_issue", "issue_key"),
        *key("dim_location", "location_key"),
        *key("dim_status", "status_code"),
    ]


def fact_checks() -> list[Check]:
    return [
        *key("fact", "request_sk"),
        reference("fact", "date_key", "dim_date"),
        reference("fact", "issue_key", "dim_issue"),
        reference("fact", "location_key", "dim_location"),
        reference("fact", "status_code", "dim_status"),
    ]


def mart_checks() -> list[Check]:
    return [
        *key("mart", "issue_quarter_key"),
        not_null("mart", "resolution_group"),
        accepted("mart", "resolution_group", GROUPS),
        *key("rpt", "request_sk"),
        Check("mart_reconciles_with_fact", "mart", "reconcile"),
        Check("rpt_reconciles_with_fact", "rpt", "reconcile"),
    ]


def gold_checks() -> list[Check]:
    return [*fact_checks(), *mart_checks()]


def all_checks(contract: Contract = Contract()) -> list[Check]:
    return [*seed_checks(), *silver_checks(contract), *dimension_checks(), *gold_checks()]


# ---------------------------------------------------------------- running
def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row_condition(check: Check) -> str:
    if check.kind == "not_null":
        return f"`{check.column}` IS NULL"
    if check.kind == "accepted":
        return f"`{check.column}` NOT IN ({', '.join(map(_quoted, check.values))})"
    return ROW_RULES[check.name]


def _row_checks(frame: DataFrame, checks: list[Check]) -> DataFrame:
    """All conditions of one table in one pass: one aggregated row, turned to a row per check."""
    counted = frame.selectExpr(*[f"count_if({_row_condition(c)}) AS c{i}" for i, c in enumerate(checks)])
    pairs = [f"struct({_quoted(c.name)} AS check_name, c{i} AS failures)" for i, c in enumerate(checks)]
    return counted.selectExpr(f"inline(array({', '.join(pairs)}))")


def _one_row_each(frame: DataFrame, checks: list[Check], columns: str) -> DataFrame:
    """A neutral row per check, so that a check over an empty table still reports."""
    rows = ", ".join(f"struct({_quoted(c.name)} AS check_name, {columns})" for c in checks)
    return frame.sparkSession.range(1).selectExpr(f"inline(array({rows}))")


def repeated_hashes(tables: Tables, checks: list[Check]) -> DataFrame:
    """``check`` and the 64-bit hashes that more than one key of it has: all that the exact count has to look at.

    Keys are long texts and nearly all differ, so a shuffle of the keys moves all of them for nothing. Of each key only
    12 bytes are shuffled here, and what comes out is as small as the number of repeated keys.
    """
    parts = [
        tables[c.table].where(f"`{c.column}` IS NOT NULL").selectExpr(
            f"{i} AS check", f"xxhash64(CAST(`{c.column}` AS string)) AS h"
        )
        for i, c in enumerate(checks)
    ]
    counted = reduce(DataFrame.unionAll, parts).groupBy("check", "h").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1").select("check", "h")


def _unique_checks(tables: Tables, checks: list[Check]) -> DataFrame:
    """Per check the number of values that occur more than once. Missing keys are the null check's business.

    Keys are told apart by hash first; only keys whose hash repeats are brought together and compared as they are.
    """
    none = _one_row_each(tables[checks[0].table], checks, "0L AS failures")
    suspects = materialise(repeated_hashes(tables, checks), "repeated_hashes")
    hit = {r["check"] for r in suspects.select("check").distinct().collect()}
    if not hit:
        return none
    small = fits_broadcast(suspects)
    parts = []
    for i in sorted(hit):
        c = checks[i]
        keys = tables[c.table].where(f"`{c.column}` IS NOT NULL").selectExpr(
            f"{_quoted(c.name)} AS check_name", f"CAST(`{c.column}` AS string) AS k"
        ).withColumn("h", F.xxhash64("k"))
        mine = suspects.where(F.col("check") == i).select("h")
        found = keys.join(F.broadcast(mine) if small else mine, "h", "left_semi")
        uses = found.groupBy("check_name", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(uses.groupBy("check_name").agg(F.count(F.lit(1)).alias("failures")))
    return reduce(DataFrame.unionAll, [none, *parts]).groupBy("check_name").agg(F.sum("failures").alias("failures"))


def _lookup_checks(tables: Tables, checks: list[Check]) -> DataFrame:
    """References count child rows without a parent, mapping checks count distinct unknown values."""
    children, parents = [], []
    for c in checks:
        name, rows = _quoted(c.name), tables[c.table]
        if c.kind == "reference" or c.column == "location_ar":
            rows = rows.where(f"`{c.column}` IS NOT NULL")
        weight = "count(1)" if c.kind == "reference" else "1L"
        children.append(
            rows.groupBy(c.column)
            .agg(F.expr(f"{weight} AS w"))
            .selectExpr(f"{name} AS check_name", f"CAST(`{c.column}` AS string) AS v", "w")
        )
        parents.append(
            tables[c.parent].selectExpr(f"{name} AS check_name", f"CAST(`{c.column}` AS string) AS v")
        )
    children.append(_one_row_each(children[0], checks, "CAST(NULL AS string) AS v, 0L AS w"))
    unknown = reduce(DataFrame.unionAll, children).join(
        reduce(DataFrame.unionAll, parents), ["check_name", "v"], "left_anti"
    )
    return unknown.groupBy("check_name").agg(F.sum("w").alias("failures"))


def totals(tables: Tables, check_name: str, contract: Contract = Contract()) -> tuple[DataFrame, DataFrame]:
    """Expected and actual row count of a reconciliation, each a one-row frame ``n``."""
    count = F.count(F.lit(1)).alias("n")
    if check_name == "mart_reconciles_with_fact":
        return tables["fact"].agg(count), tables["mart"].agg(
            F.coalesce(F.sum("total_requests"), F.lit(0)).alias("n")
        )
    if check_name == "rpt_reconciles_with_fact":
        return tables["fact"].agg(count), tables["rpt"].agg(count)
    # the same rules that Silver is built by, so both agree on what is dropped
    return tables["bronze"].agg(F.count_if(~dropped(contract)).alias("n")), tables["silver"].agg(count)


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row ``expected, actual, failures``: two totals side by side without a join."""
    zero = F.lit(0).cast("long")
    both = expected.select(F.col("n").alias("e"), zero.alias("a")).unionByName(
        actual.select(zero.alias("e"), F.col("n").alias("a"))
    )
    return both.agg(F.sum("e").alias("expected"), F.sum("a").alias("actual")).select(
        "expected", "actual", (F.col("expected") != F.col("actual")).cast("long").alias("failures")
    )


ROW_KINDS = ("not_null", "accepted", "row_rule")
LOOKUP_KINDS = ("reference", "unmapped")


def run_checks(tables: Tables, checks: Sequence[Check], contract: Contract = Contract()) -> DataFrame:
    """One row per check: name, table, kind, failures, severity, status."""
    def of(kinds: Sequence[str], table: str | None = None) -> list[Check]:
        return [c for c in checks if c.kind in kinds and table in (None, c.table)]

    parts = [
        _row_checks(tables[table], of(ROW_KINDS, table))
        for table in dict.fromkeys(c.table for c in of(ROW_KINDS))
    ]
    if of(["unique"]):
        parts.append(_unique_checks(tables, of(["unique"])))
    if of(LOOKUP_KINDS):
        parts.append(_lookup_checks(tables, of(LOOKUP_KINDS)))
    for c in of(["reconcile"]):
        compared = reconcile(*totals(tables, c.name, contract))
        parts.append(compared.selectExpr(f"{_quoted(c.name)} AS check_name", "failures"))
    return judged(reduce(DataFrame.unionAll, parts), checks)


def judged(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Attach the declaration to ``(check_name, failures)`` and turn counts into a status."""
    never = 1 << 62
    declared = ", ".join(
        f"{_quoted(c.name)}, struct({_quoted(c.table)} AS t, {_quoted(c.kind)} AS k, {_quoted(c.severity)} AS s, "
        f"{c.warn_above}L AS w, {never if c.error_above is None else c.error_above}L AS e)"
        for c in checks
    )
    return counted.selectExpr("check_name", "failures", f"map({declared})[check_name] AS d").selectExpr(
        "check_name",
        "d.t AS table_name",
        "d.k AS kind",
        "CAST(failures AS bigint) AS failures",
        "d.s AS severity",
        "CASE WHEN failures > d.e THEN 'error' WHEN failures > d.w THEN 'warn' ELSE 'pass' END AS status",
    )


def suite_summary(results: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row: checks declared and run, and how they ended."""
    return results.agg(
        F.lit(len(checks)).cast("long").alias("declared"),
        F.count(F.lit(1)).alias("ran"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "error").alias("failed"),
        (F.count(F.lit(1)) == len(checks)).alias("is_complete"),
    )


class QualityGate(RuntimeError):
    """A layer failed its checks; the next layer is not built."""


def gate(results: DataFrame, checks: Sequence[Check]) -> list:
    """Bring the suite's rows (one per declared check) to the driver and stop on a failure."""
    rows = results.collect()
    if len(rows) != len(checks):
        raise QualityGate(f"{len(rows)} checks ran, {len(checks)} are declared")
    failed = [f"{r['check_name']} ({r['failures']})" for r in rows if r["status"] == "error"]
    if failed:
        raise QualityGate("failed: " + ", ".join(sorted(failed)))
    return rows
