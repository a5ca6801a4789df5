import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
#: Names that operators use inside.
CLASHES = ["masked", "p_text", "p_good", "digest", "gone", "token_ids", "k0", "i0", "d0", "new", "words_digest", "row", "value"]
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def rows():
    long = " ".join(f"word{i % 997} other{i % 89}." for i in range(60_000))
    near = "the quick brown fox jumps over the lazy dog while all the other animals of the wood look on and wonder " * 3
    return [
        (1, near, "en", "a", len(near)), (2, near, "en", "a", len(near)), (2, near, "en", "a", len(near)),
        (3, near + "indeed", "en", "b", None), (4, None, None, None, None), (None, "A text without an id.", "en", "a", 21),
        (None, None, None, None, None), (5, "", "en", "a", 0), (6, long, "de", "c", len(long)), (7, f"So {PASSAGE} ends", "fr", "d", 9),
        (8, PASSAGE, "fr", "d", 9), (9, 'call it token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here', "en", "e", 5),
        (10, "Some text.\nReleased under the MIT License.\n4845168114407329 é ß 한국", "en", "e", 7), (11, "!!! ...", "en", "f", 7),
        (12, "<|endoftext|> <|im_end|>", "en", "g", 3),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), DOCUMENTS)


@pytest.fixture(scope="module")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
