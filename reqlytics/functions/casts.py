"""Text to number / timestamp casts that give null instead of a guess.

Spark's own casts accept more than the source's rules do (``1d`` as a number, ``2026`` as a
timestamp, a dropped zone suffix), so each cast is guarded by the exact accepted shape.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted shapes.
NUMBER_SHAPE = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity)|(?i:nan))$"
DATETIME_SHAPE = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ Tt][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,6})?)?$"
)


def safe_double(c: Column) -> Column:
    return F.when(c.rlike(NUMBER_SHAPE), c.try_cast("double"))


def safe_datetime(c: Column) -> Column:
    """Civil date-time without a zone."""
    return F.when(c.rlike(DATETIME_SHAPE), F.upper(c).try_cast("timestamp_ntz"))
