"""Finding spellings that mean the same thing, and names that were cut short."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqlytics.functions.text import match_key, squeeze


def spelling_variants(df: DataFrame, column: str) -> DataFrame:
    """Every cleaned spelling with its match key, its use count and the canonical spelling.

    Spellings that differ only in hyphens, slashes, parentheses or spaces share a match key; the
    most used one is canonical (the smaller text on a tie). Rows are counted per spelling before
    anything else, so what is shuffled afterwards is the vocabulary, not the data. Keys travel as
    digests, since a text can be long.
    """
    spelling = squeeze(F.col(column))
    counted = (
        df.where(F.col(column).isNotNull())
        .select(spelling.alias("spelling"))
        .groupBy("spelling")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("match_digest", F.md5(match_key(F.col("spelling")).cast("binary")))
    )
    best = counted.groupBy("match_digest").agg(
        # largest count first, then smallest text: min over (-count, text)
        F.min(F.struct((-F.col("n_rows")).alias("rank"), F.col("spelling"))).alias("best"),
        F.count(F.lit(1)).alias("n_spellings"),
    )
    return counted.join(best, "match_digest").select(
        "spelling",
        "match_digest",
        F.col("best.spelling").alias("canonical"),
        "n_rows",
        "n_spellings",
    )


def text_groups(df: DataFrame, column: str) -> DataFrame:
    """Groups of long texts with the same match key: sizes and the digest of the canonical text.

    Whole texts are cleaned and digested where they are read; only digests and counts are shuffled.
    The most used spelling is canonical, the smaller digest on a tie.
    """
    clean = squeeze(F.col(column))
    digests = (
        df.where(F.col(column).isNotNull())
        .select(clean.alias("text"))
        .select(
            F.md5(match_key(F.col("text")).cast("binary")).alias("match_digest"),
            F.md5(F.col("text").cast("binary")).alias("digest"),
            F.length("text").alias("length"),
        )
    )
    spellings = digests.groupBy("match_digest", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("length")
    )
    return spellings.groupBy("match_digest").agg(
        F.sum("n").alias("documents"),
        F.count(F.lit(1)).alias("spellings"),
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("digest")))["digest"].alias("canonical_digest"),
        F.max("length").alias("longest"),
    )


def truncated_names(df: DataFrame, column: str, at_least: int = 2) -> DataFrame:
    """One-word names that are the first word of several longer names: candidates for a cut name.

    An equi-join on the first word: each longer name meets one candidate at most.
    """
    filled = df.where(F.col(column).isNotNull())
    names = filled.select(squeeze(F.col(column)).alias("name")).distinct()
    words = names.withColumn("first_word", F.substring_index("name", " ", 1))
    longer = (
        words.where(F.col("name") != F.col("first_word"))
        .groupBy("first_word")
        .agg(F.count(F.lit(1)).alias("n_longer_names"))
        .where(F.col("n_longer_names") >= at_least)
    )
    short = words.where(F.col("name") == F.col("first_word")).select("name", "first_word")
    return short.join(longer, "first_word").select("name", "n_longer_names")
