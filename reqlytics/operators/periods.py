"""Change from one period to the one before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DEAD_BAND = 1e-9


def judge(change: Column, lower_is_better: bool = True) -> Column:
    """``good`` / ``bad``; null where there is no earlier period or no real change."""
    improved = (change < 0) if lower_is_better else (change > 0)
    return F.when(F.abs(change) >= DEAD_BAND, F.when(improved, "good").otherwise("bad"))


def with_previous(
    df: DataFrame, period: str, columns: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Add ``prev_<period>`` and ``prev_<c>`` from the preceding period.

    ``df`` has one row per period (and ``within``), so without ``within`` the window sees as many
    rows as there are periods on record.
    """
    w = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    w = w.orderBy(period)
    return df.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in [period, *columns]])
