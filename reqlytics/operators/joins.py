"""Lookup joins whose physical strategy rests on a measured size, not on a hope."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reqlytics.sources.warehouse import materialise

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64
HOT_ROWS = 10_000_000


def fit_broadcast(
    sides: Sequence[DataFrame],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> list[bool]:
    """Measure all ``sides`` in one job: at most ``max_rows`` rows and ``max_bytes`` of text each.

    Every task adds up its own part and sends one row. (A limit would not make it cheaper: it moves
    the limited rows of all tasks into one.)
    """
    def measured(index: int, side: DataFrame) -> DataFrame:
        width = " + ".join(f"coalesce(octet_length(cast(`{c}` AS string)), 0) + 8" for c in side.columns)
        return side.selectExpr(f"{width} AS w").agg(
            F.lit(index).alias("i"), F.count("w").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("b")
        )

    sizes = reduce(DataFrame.unionAll, [measured(i, s) for i, s in enumerate(sides)])
    return [r["n"] <= max_rows and r["b"] <= max_bytes for r in sorted(sizes.collect())]


def fits_broadcast(side: DataFrame, **bounds: int) -> bool:
    return fit_broadcast([side], **bounds)[0]


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    spread_by: Column | None = None,
    small: bool | None = None,
    salts: int = SALTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a fact-sized frame to a lookup that has one row per key.

    A lookup within the broadcast bound is broadcast: the big side is not shuffled at all. Beyond
    the bound it is a shuffle join in which hot keys are split. Keys with more than ``hot_rows``
    rows are counted out first; there are at most rows / hot_rows of them, so *they* can be
    broadcast. Rows with a hot key or no key get a salt from ``spread_by`` (a near-unique column, so
    a row keeps its salt when a task is retried), and only the lookup rows of hot keys are copied
    once per salt. All other keys join as they are.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return big.join(F.broadcast(lookup), keys, how)
    if spread_by is None:
        return big.join(lookup, keys, how)

    counted = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = materialise(counted.select(*keys, F.lit(True).alias("_hot")), "hot_keys")
    no_key = F.isnull(keys[0])
    for k in keys[1:]:
        no_key = no_key | F.isnull(k)
    is_hot = F.coalesce("_hot", F.lit(False))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    salted = big.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(is_hot | no_key, salt).otherwise(0)
    )
    last = F.when(is_hot, salts - 1).otherwise(0)
    copies = (
        lookup.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_hot")
    )
    return salted.drop("_hot").join(copies, [*keys, "_salt"], how).drop("_salt")
