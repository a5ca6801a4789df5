"""From raw documents to token ids: quality, near duplicates, benchmark passages, secrets, BPE.

Each stage works on all that the one before kept; its result is written as Parquet and read again as the next
one's input. All but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage
changes it. The last returns a row per document with its token ids (little-endian unsigned 32-bit integers).

Every stage takes whole texts, of any length. Null ids stay null. An empty table goes through as one. Further columns of any
name are carried through the first four stages unchanged. What a stage does with null and empty texts, ties and repeated
rows stands with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reqlytics.llm import decontaminate, jaccard, quality, secrets, tokens
from reqlytics.llm.common import materialise, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now is."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts: a score of exactly the threshold stays.

    Null and empty texts are scored like any other, by their page and as no words; repeated rows share their fate.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of word 5-gram similarity 0.8 or more: that of the smallest id.

    Texts without words (null, empty, marks only) are like nothing and all stay; of rows repeated with id and text one stays.
    """
    return jaccard.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark; documents that were nothing else go.

    Null and empty texts have no passage and stay as they are; repeated rows are cut alike.
    """
    return _sized(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark; all documents stay, null and empty texts as they are.

    A score of exactly the threshold counts as a secret; repeated rows are masked alike.
    """
    return _sized(secrets.masked(docs, secrets.train(docs)))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``token_ids``, and digests of the ids and of the text they decode to.

    A row for every row: a null text is encoded as an empty one, which has no tokens.
    """
    return tokens.digests(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", encode_tokens),
]

#: Trained models decide in several stages: SQL cannot express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
