"""Exact medians that never bring one group's values into one task.

``percentile`` keeps every distinct value of a group in one task's memory, and a window percentile
sorts every row of the group there. When one group holds a third of a very large table neither is
safe on raw rows. Where values repeat, as whole hours do, medians start from a *count table* (group, value, how often):

* rows collapse to it before the shuffle, and the shuffle is on group and value, so a large group
  is spread over all tasks;
* it is written once and read by everything after it, so the source is scanned once;
* it tells how many distinct values the widest group has. Up to ``MAX_VALUES`` (whole hours stay
  far below) the built-in weighted ``percentile`` reads the median off with a proven memory bound;
* beyond that the median is selected by rank: the counts collapse to a histogram of a bounded
  number of logarithmic buckets, its running sum shows which bucket holds the median, and only
  values inside that bucket are ordered.

Where values hardly repeat a count table would be as large as the rows. :func:`aggregate_rows_with_median` writes none:
one pass gives the sums and sizes of the groups, groups of few rows are read off directly, and a sketch of the distinct
values of the others decides between a count table and the selection by rank straight from the rows. Then a histogram
brackets the middle ranks, and only values inside the bracket are kept.

All ways equal linear interpolation at 0.5 over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reqlytics.operators.joins import fits_broadcast, lookup_join
from reqlytics.sources.warehouse import materialise, materialise_counted

MAX_VALUES = 20_000
BUCKETS_PER_OCTAVE = 4096
#: Buckets of a histogram that is taken from rows: few, so that rows of a group combine before the shuffle.
ROW_BUCKETS_PER_OCTAVE = 64


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "median", max_values: int = MAX_VALUES
) -> DataFrame:
    """One row per key with the exact median of the non-null, non-NaN ``value``."""
    rolled = [F.count(F.lit(1)).alias("_rows")]
    result = aggregate_rows_with_median(df, keys, value, rolled, [F.sum("_rows").alias("_rows")], out, max_values)
    return result.drop("_rows").where(F.col(out).isNotNull())


def aggregate_rows_with_median(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    rolled: Sequence[Column],
    aggs: Sequence[Column],
    out: str,
    max_values: int = MAX_VALUES,
) -> DataFrame:
    """Aggregate ``rows`` to ``keys`` with the median of ``value``, without a table of all values.

    ``rolled`` are additive aggregates of the rows, ``aggs`` are taken over these. Rows with a null or NaN value
    count there, not in the median. Null keys are a group like any other.
    """
    keys = list(keys)
    usable = F.when(~F.isnan(value), F.col(value).cast("double"))
    sums = materialise(rows.groupBy(*keys).agg(*rolled, F.count(usable).alias("_usable")), "group_sums")
    whole = sums.groupBy(*keys).agg(*aggs)
    group = F.struct(*keys) if keys else F.lit(0)
    values = rows.select(group.alias("_group"), usable.alias("_v")).where("_v IS NOT NULL")
    wide = sums.where(F.col("_usable") > max_values).select(group.alias("_group"), F.lit(True).alias("_wide"))
    if wide.isEmpty():
        medians = values.groupBy("_group").agg(F.percentile("_v", 0.5).alias(out))
    else:
        small = fits_broadcast(wide)
        told = lookup_join(values, wide, "_group", "left", F.col("_v"), small)
        few = told.where("_wide IS NULL").groupBy("_group").agg(F.percentile("_v", 0.5).alias(out))
        medians = few.unionByName(_wide_medians(told.where("_wide").drop("_wide"), out, max_values))
    if keys:
        return whole.withColumn("_group", group).join(medians, "_group", "left").drop("_group")
    return whole.select("*", medians.select(out).scalar().alias(out))


def _wide_medians(values: DataFrame, out: str, max_values: int) -> DataFrame:
    """Medians of groups of many rows: by counts where a sketch finds few distinct values, else by rank."""
    distinct = values.groupBy("_group").agg(F.approx_count_distinct("_v", 0.02).alias("n"))
    if max_values and distinct.agg(F.max("n")).first()[0] <= max_values // 2:
        counts = values.groupBy("_group", "_v").agg(F.count(F.lit(1)).alias("_n"))
        return counts.groupBy("_group").agg(F.percentile("_v", 0.5, F.col("_n")).alias(out))
    weighed = values.withColumn("_n", F.lit(1).cast("long"))
    return select_by_rank(weighed, ["_group"], "_v", "_n", out, ROW_BUCKETS_PER_OCTAVE)


def aggregate_with_median(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    aggs: Sequence[Column],
    out: str,
    max_values: int = MAX_VALUES,
    stored: bool = False,
) -> DataFrame:
    """Aggregate a count table to ``keys`` with ``aggs`` and the median of ``value``.

    ``counts`` has one row per (keys, value), any number of additive measures, and ``weight``, the
    number of rows behind it. Rows with a null or NaN value count in ``aggs``, not in the median.
    ``stored``: it comes from a small table that is kept anyway, and is not written once more.
    """
    keys = list(keys)
    if stored:
        widest = counts.count()
    else:
        counts, widest = materialise_counted(counts, "value_counts")
    if widest > max_values:  # all groups together; look at the widest one alone
        group_sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        widest = group_sizes.agg(F.max("n")).first()[0]
    if widest <= max_values:
        usable = F.when(~F.isnan(value), F.col(value))
        return counts.groupBy(*keys).agg(*aggs, F.percentile(usable, 0.5, F.col(weight)).alias(out))
    sums = counts.groupBy(*keys).agg(*aggs)
    medians = select_by_rank(counts, keys, value, weight, out)
    if keys:
        return sums.join(medians, keys, "left")
    return sums.select("*", medians.scalar().alias(out))


def log_bucket(v: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """A non-decreasing map of any double to a bounded set of whole numbers."""
    return F.signum(v) * F.floor(F.log2(F.abs(v) + 1.0) * per_octave).cast("double")


def even_bucket(v: Column, low: Column, high: Column, parts: int = BUCKETS_PER_OCTAVE) -> Column:
    """Which of ``parts`` equal steps from ``low`` to ``high`` a value is in; the ends are never in the same."""
    share = F.try_divide(v * 0.5 - low * 0.5, high * 0.5 - low * 0.5)
    return F.coalesce(F.floor(share * parts).cast("double"), F.when(v >= high, float(parts)).otherwise(0.0))


def select_by_rank(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    out: str,
    per_octave: int = BUCKETS_PER_OCTAVE,
    most: int = MAX_VALUES,
) -> DataFrame:
    """Median per key of a (keys, value, weight) table or of rows with weight 1, by counting ranks.

    A histogram shows which bucket holds the middle ranks of a group; that bucket is cut into equal steps
    between its least and largest value, and so on, until no group has more than ``most`` values left. Only
    those are ordered, so a task never holds more of a group, whatever its range. Where the two middle ranks
    fall into different buckets they are the largest value of one and the least of the other.
    """
    keys = list(keys)
    named = keys or ["_k"]
    counts = counts.where(F.col(value).isNotNull() & ~F.isnan(value)).select(
        *(keys or [F.lit(0).alias("_k")]), F.col(value).cast("double").alias("_v"), F.col(weight).alias("_n")
    )
    group = Window.partitionBy(*named)
    running = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_bn").over(group)
    bounds = None
    while True:
        if bounds is None:
            rows = counts.select(
                "*", log_bucket(F.col("_v"), per_octave).alias("_b"), F.lit(0).cast("long").alias("_skip"),
                F.lit(None).cast("long").alias("_r0"), F.lit(None).cast("long").alias("_r1"),
            )
        else:
            rows = _inside(counts, bounds.where(F.col("_size") > most), named).withColumn("_b", even_bucket(F.col("_v"), F.col("_lo"), F.col("_hi")))
        histogram = rows.groupBy(*named, "_b").agg(
            F.sum("_n").alias("_bn"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_size"),
            F.min("_skip").alias("_skip"), F.min("_r0").alias("_r0"), F.min("_r1").alias("_r1"),
        )
        ranked = histogram.select(
            *named, "_lo", "_hi", "_bn", "_size",
            (F.col("_skip") + F.sum("_bn").over(running) - F.col("_bn")).alias("_before"),
            F.coalesce("_r0", F.floor((total + 1) / 2).cast("long")).alias("_r0"),
            F.coalesce("_r1", F.floor((total + 2) / 2).cast("long")).alias("_r1"),
        )
        around = (F.col("_before") + F.col("_bn") >= F.col("_r0")) & (F.col("_before") < F.col("_r1"))
        apart = (F.count(F.lit(1)) > 1) | (F.min("_lo") == F.max("_hi"))  # nothing to order between two buckets, or equals
        found = ranked.where(around).groupBy(*named).agg(
            F.when(apart, F.min("_hi")).otherwise(F.min("_lo")).alias("_lo"),
            F.when(apart, F.max("_lo")).otherwise(F.max("_hi")).alias("_hi"),
            F.min("_before").alias("_skip"),
            F.min("_r0").alias("_r0"),
            F.min("_r1").alias("_r1"),
            F.when(apart, F.lit(0)).otherwise(F.sum("_size")).alias("_size"),
        )
        # groups that are done keep their bounds
        if bounds is not None:
            found = found.unionByName(bounds.where(F.col("_size") <= most))
        bounds = materialise_counted(found, "median_bounds")[0]
        if (bounds.agg(F.max("_size")).first()[0] or 0) <= most:
            break
    known = bounds.where("_size = 0").select(*named, (F.col("_lo") * 0.5 + F.col("_hi") * 0.5).alias(out))
    near = _inside(counts, bounds.where("_size > 0"), named)
    upto = F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = near.select("*", (F.col("_skip") + upto).alias("_end")).where(
        (F.col("_end") >= F.col("_r0")) & (F.col("_end") - F.col("_n") < F.col("_r1"))
    )
    low, high = F.min("_v"), F.max("_v")
    answer = F.when(low == high, low).otherwise(low * 0.5 + high * 0.5)
    medians = middle.groupBy(*named).agg(answer.alias(out)).unionByName(known)
    return medians if keys else medians.select(out)


def _inside(counts: DataFrame, bounds: DataFrame, named: list[str]) -> DataFrame:
    """Values within the bounds of their group; groups without bounds drop out."""
    joined = lookup_join(counts, bounds, named, "inner", F.col("_v"))
    return joined.where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
