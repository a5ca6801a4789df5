"""Dashboard queries over the reporting table and the issue mart.

Every function returns a frame; those with a median (KPIs, published gate, period delta) run one job when
they are called, which writes their count table. ``quarters`` restricts the period (None: everything on
record); it reaches the scan as a partition filter where the table is partitioned by quarter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reqlytics.contract import PUBLISHED_SHARE
from reqlytics.functions.labels import (
    FLAGGED_GROUPS,
    INSUFFICIENT,
    REVIEW_ORDER,
    group_label,
    month_label,
    period_label,
    pick_language,
    review_rank,
)
from reqlytics.operators.median import aggregate_with_median
from reqlytics.operators.periods import judge, with_previous

Quarters = Sequence[str] | None
# Fixed value: the location type that is shown.
NEIGHBOURHOOD = "neighborhood"
SMALLEST_LOG_HOURS = 0.5


def in_period(df: DataFrame, quarters: Quarters) -> DataFrame:
    return df if quarters is None else df.where(F.col("source_quarter").isin(list(quarters)))


def _volume() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("requests"),
        F.avg("is_repeated_int").alias("repeat_rate"),
    ]


# ---------------------------------------------------------------- periods and headline figures
def available_quarters(rpt: DataFrame) -> DataFrame:
    return rpt.select("source_quarter").distinct().orderBy("source_quarter")


def period_labels(rpt: DataFrame, lang: str = "en") -> DataFrame:
    """The period choices: every quarter, and the whole range under the code ``ALL``."""
    quarters = rpt.select("source_quarter").distinct()
    code = F.col("source_quarter")
    single = quarters.select(code.alias("period"), period_label(code, code, lang).alias("label"))
    whole = quarters.agg(F.min(code).alias("a"), F.max(code).alias("b")).select(
        F.lit("ALL").alias("period"), period_label(F.col("a"), F.col("b"), lang).alias("label")
    )
    return single.unionByName(whole)


COUNTED = ["n", "repeated", "flagged", "completed", "published"]


def hour_counts(rpt: DataFrame, keys: Sequence[str] = ("source_quarter",)) -> DataFrame:
    """Counts per (keys, closure hours): all that headline figures of any set of periods need.

    Counts of periods add up to the counts of their union, and an exact median follows from them, so this table,
    kept beside the report, answers every choice of periods without a look at the report's rows.
    """
    return rpt.groupBy(*keys, "closure_hours_kpi").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_repeated_int").alias("repeated"),
        F.count("is_repeated_int").alias("flagged"),
        F.sum("is_completed_int").alias("completed"),
        F.sum("has_published_status").alias("published"),
    )


def _headline(base: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and exact median of report rows or of stored :func:`hour_counts`."""
    stored = set(COUNTED) <= set(base.columns)
    if stored:
        hours = base.groupBy(*keys, "closure_hours_kpi").agg(*[F.sum(c).alias(c) for c in COUNTED])
    else:
        hours = hour_counts(base, keys)
    return aggregate_with_median(
        hours,
        keys,
        value="closure_hours_kpi",
        weight="n",
        aggs=[
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.try_divide(F.sum("repeated"), F.sum("flagged")).alias("repeat_rate"),
            F.try_divide(F.sum("completed"), F.sum("published")).alias("completion"),
            F.sum("published").alias("with_status"),
        ],
        out="median_closure",
        stored=stored,
    )


def kpis(rpt: DataFrame, quarters: Quarters = None) -> DataFrame:
    """One row: volume, repeat rate, completion, rows with a status, median closure hours.

    ``rpt`` is the report or, here and in the two functions below, the stored counts of :func:`hour_counts`.
    """
    return _headline(in_period(rpt, quarters), [])


def _published() -> Column:
    """Too few published statuses say nothing about completion."""
    return F.coalesce(F.try_divide("with_status", "total") >= PUBLISHED_SHARE, F.lit(False))


def published_gate(rpt: DataFrame, quarters: Quarters = None) -> DataFrame:
    """Headline figures with completion hidden where hardly any status was published."""
    return kpis(rpt, quarters).select(
        "total",
        "with_status",
        _published().alias("is_published"),
        F.when(_published(), F.col("completion")).alias("completion_shown"),
    )


def period_delta(rpt: DataFrame, lang: str = "en") -> DataFrame:
    """Headline figures of every quarter against the quarter before it.

    Volume changes are relative, the median's absolute in hours, the repeat rate's in points.
    """
    per_quarter = _headline(rpt, ["source_quarter"])
    seen = with_previous(per_quarter, "source_quarter", ["total", "median_closure", "repeat_rate"])
    code, before = F.col("source_quarter"), F.col("prev_source_quarter")
    return seen.select(
        "source_quarter",
        "prev_source_quarter",
        period_label(code, code, lang).alias("period"),
        F.when(before.isNotNull(), period_label(before, before, lang)).alias("prev_period"),
        "total",
        "repeat_rate",
        F.when(_published(), F.col("completion")).alias("completion_shown"),
        "median_closure",
        (F.try_divide("total", "prev_total") - 1).alias("total_change"),
        (F.col("median_closure") - F.col("prev_median_closure")).alias("median_change"),
        ((F.col("repeat_rate") - F.col("prev_repeat_rate")) * 100).alias("repeat_points"),
        judge(F.col("median_closure") - F.col("prev_median_closure")).alias("median_verdict"),
        judge(F.col("repeat_rate") - F.col("prev_repeat_rate")).alias("repeat_verdict"),
    )


# ---------------------------------------------------------------- breakdowns of the reporting table
def domains(rpt: DataFrame, quarters: Quarters = None) -> DataFrame:
    return in_period(rpt, quarters).groupBy("domain_ar", "domain_en").agg(*_volume())


def domain_bars(rpt: DataFrame, quarters: Quarters = None, lang: str = "en") -> DataFrame:
    """Domains in one language, smallest first, as a ranked bar list reads."""
    label = pick_language("domain_ar", "domain_en", lang)
    return (
        domains(rpt, quarters)
        .select(F.col(label).alias("domain"), "requests", "repeat_rate")
        .orderBy("requests", "domain")
    )


def trend(rpt: DataFrame, quarters: Quarters = None, lang: str = "en") -> DataFrame:
    return (
        in_period(rpt, quarters)
        .groupBy("year_month")
        .agg(*_volume())
        .select("*", month_label(F.col("year_month"), lang).alias("month"))
        .orderBy("year_month")
    )


def locations(
    rpt: DataFrame, quarters: Quarters = None, coordinates: DataFrame | None = None
) -> DataFrame:
    """Neighbourhood volume and rate. Coordinates are looked up after the aggregation."""
    places = (
        in_period(rpt, quarters)
        .where(F.col("location_type") == NEIGHBOURHOOD)
        .groupBy("location_label_ar", "location_en")
        .agg(*_volume())
    )
    if coordinates is None:
        nowhere = F.lit(None).cast("double")
        return places.select("*", nowhere.alias("lat"), nowhere.alias("lon"))
    one_each = coordinates.groupBy(F.col("location_label").alias("location_label_ar")).agg(
        F.max("lat").alias("lat"), F.max("lon").alias("lon")
    )
    return places.join(one_each, "location_label_ar", "left")


def placed_locations(places: DataFrame) -> DataFrame:
    """Those that can be put on a map."""
    return places.dropna(subset=["lat", "lon"])


def placement_summary(places: DataFrame) -> DataFrame:
    missing = F.col("lat").isNull() | F.col("lon").isNull()
    return places.agg(
        F.count(F.lit(1)).alias("neighborhoods"), F.count_if(missing).alias("not_placed")
    )


def top_locations(places: DataFrame, k: int = 15) -> DataFrame:
    return places.orderBy(F.desc("requests"), "location_label_ar", "location_en").limit(k)


def reliability(rpt: DataFrame, quarters: Quarters = None) -> DataFrame:
    """Counts behind the trust page, and their shares of all requests."""
    counts = in_period(rpt, quarters).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status_code") == "not_published").alias("no_status"),
        F.count_if(F.col("closure_basis") == "closure_value_only").alias("closure_only"),
        F.count_if(F.col("location_type") != NEIGHBOURHOOD).alias("no_neighborhood"),
        F.count_if("is_closure_outlier").alias("outliers"),
    )
    shares = [
        F.try_divide(c, "total").alias(f"{c}_share")
        for c in ("no_status", "closure_only", "no_neighborhood")
    ]
    return counts.select("*", *shares)


# ---------------------------------------------------------------- views of the issue mart
# The output columns of the matrix.
MATRIX = [
    "source_quarter", "issue_ar", "issue_en", "total_requests", "repeated_requests", "repeat_rate",
    "median_closure_hours", "resolution_group", "closure_threshold_hours", "repeat_threshold",
]


def matrix(mart: DataFrame, quarters: Quarters = None) -> DataFrame:
    return in_period(mart, quarters).select(*MATRIX)


def persistent(mart: DataFrame) -> DataFrame:
    """Issues flagged in every quarter on record, whatever period is selected."""
    quarters_on_record = mart.agg(F.count_distinct("source_quarter").alias("n"))
    return (
        mart.where(F.col("resolution_group").isin(FLAGGED_GROUPS))
        .groupBy("issue_ar", "issue_en")
        .agg(
            F.sum("total_requests").alias("requests"),
            F.avg("repeat_rate").alias("repeat_rate"),
            F.count_distinct("source_quarter").alias("_quarters"),
        )
        .where(F.col("_quarters") == quarters_on_record.scalar())
        .drop("_quarters")
        .orderBy(F.desc("requests"), "issue_en", "issue_ar")
    )


def persistent_bars(mart: DataFrame, k: int = 7, lang: str = "en") -> DataFrame:
    """The ``k`` largest persistent issues, then lowest rate first."""
    label = pick_language("issue_ar", "issue_en", lang)
    largest = persistent(mart).limit(k)
    return largest.select(F.col(label).alias("issue"), "requests", "repeat_rate").orderBy(
        "repeat_rate", "issue"
    )


def group_volume(mart: DataFrame, quarters: Quarters = None, lang: str = "en") -> DataFrame:
    return (
        in_period(mart, quarters)
        .where(F.col("resolution_group") != INSUFFICIENT)
        .groupBy("resolution_group")
        .agg(F.sum("total_requests").alias("total_requests"))
        .select("*", group_label(F.col("resolution_group"), lang).alias("label"))
    )


def most_repeated(mart: DataFrame, quarters: Quarters = None, k: int = 8) -> DataFrame:
    """Across quarters the rate is weighted: repeated over total."""
    return (
        in_period(mart, quarters)
        .groupBy("issue_ar", "issue_en")
        .agg(
            F.sum("repeated_requests").alias("repeated_requests"),
            F.sum("total_requests").alias("total_requests"),
        )
        .select("*", F.try_divide("repeated_requests", "total_requests").alias("repeat_rate"))
        .orderBy(F.desc("repeated_requests"), "issue_en", "issue_ar")
        .limit(k)
    )


def flagged_summary(mart: DataFrame, quarters: Quarters = None) -> DataFrame:
    """How many issue types are flagged, and what share of all requests they hold."""
    flagged = F.col("resolution_group").isin(FLAGGED_GROUPS)
    return in_period(mart, quarters).agg(
        F.count_distinct(F.when(flagged, F.col("issue_en"))).alias("flagged_issues"),
        F.coalesce(F.sum(F.when(flagged, F.col("total_requests"))), F.lit(0)).alias("flagged_requests"),
        F.sum("total_requests").alias("total_requests"),
        F.try_divide(
            F.coalesce(F.sum(F.when(flagged, F.col("total_requests"))), F.lit(0)),
            F.sum("total_requests"),
        ).alias("flagged_share"),
    )


def focus_quarter(mart: DataFrame, quarters: Quarters = None) -> DataFrame:
    """Rows of the latest selected quarter."""
    chosen = in_period(mart, quarters)
    latest = chosen.agg(F.max("source_quarter").alias("q"))
    return chosen.where(F.col("source_quarter") == latest.scalar())


def review_first(
    mart: DataFrame, quarters: Quarters = None, k: int = 5, lang: str = "en"
) -> DataFrame:
    """What to look at first in the focus quarter: by group, then by volume."""
    label = pick_language("issue_ar", "issue_en", lang)
    return (
        focus_quarter(mart, quarters)
        .where(F.col("resolution_group").isin(REVIEW_ORDER))
        .select(
            "source_quarter",
            F.col(label).alias("issue"),
            review_rank(F.col("resolution_group")).alias("rank"),
            group_label(F.col("resolution_group"), lang).alias("group"),
            "total_requests",
            "median_closure_hours",
            "repeat_rate",
        )
        .orderBy("rank", F.desc("total_requests"), "issue")
        .limit(k)
    )


def bubbles(mart: DataFrame, quarters: Quarters = None, lang: str = "en") -> DataFrame:
    """Focus quarter's issues with enough data. A log axis has no zero, so hours start at 0.5."""
    hours = F.col("median_closure_hours")
    label = pick_language("issue_ar", "issue_en", lang)
    return (
        focus_quarter(mart, quarters)
        .where(F.col("resolution_group") != INSUFFICIENT)
        .select(
            "source_quarter",
            F.col(label).alias("issue"),
            F.when(hours < SMALLEST_LOG_HOURS, SMALLEST_LOG_HOURS).otherwise(hours).alias("x"),
            "repeat_rate",
            "total_requests",
            "median_closure_hours",
            "resolution_group",
            group_label(F.col("resolution_group"), lang).alias("group_label"),
            "closure_threshold_hours",
            "repeat_threshold",
        )
    )
