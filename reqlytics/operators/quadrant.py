"""Speed x recurrence quadrant within a period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reqlytics.functions.labels import DELAY, EFFECTIVE, INSUFFICIENT, PRIORITY, ROOT_CAUSE


def quadrant(
    enough: Column, speed: Column, speed_limit: Column, rate: Column, rate_limit: Column
) -> Column:
    """Group label; at or below a limit is the good side on both axes.

    A comparison with a missing limit is neither good nor bad on its axis, and such a row lands in
    the last group, the one to look at first.
    """
    fast, slow = speed <= speed_limit, speed > speed_limit
    steady, returning = rate <= rate_limit, rate > rate_limit
    return (
        F.when(~enough | speed.isNull(), INSUFFICIENT)
        .when(fast & steady, EFFECTIVE)
        .when(fast & returning, ROOT_CAUSE)
        .when(slow & steady, DELAY)
        .otherwise(PRIORITY)
    )


def with_quadrant(
    cells: DataFrame,
    period: str,
    size: str,
    speed: str,
    rate: str,
    repeated: str,
    flagged: str,
    min_size: int,
    speed_limit: str = "closure_threshold_hours",
    rate_limit: str = "repeat_threshold",
    group: str = "resolution_group",
) -> DataFrame:
    """Add both limits and the group to a (period, subject) table.

    The speed limit is the median speed of the period's subjects that are large enough. The rate
    limit is the mean over the period's *rows* whose flag is known, so it comes from sums, not from
    the subjects' rates. One partition of the window holds one period's subjects.
    """
    peers = Window.partitionBy(period)
    enough = F.col(size) >= min_size
    return cells.select(
        "*",
        F.percentile(F.when(enough, F.col(speed)), 0.5).over(peers).alias(speed_limit),
        F.try_divide(F.sum(repeated).over(peers), F.sum(flagged).over(peers)).alias(rate_limit),
    ).withColumn(
        group,
        quadrant(enough, F.col(speed), F.col(speed_limit), F.col(rate), F.col(rate_limit)),
    )
