import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from aerolake.llm.common import tune

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("key", StringType()),
        StructField("score", StringType()),
        StructField("node", StringType()),
        StructField("n_chars", LongType()),
    ]
)

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))

ODD = [
    (1, "The cat sat on the mat, it's said; don't  they\n\nknow?"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "The cat sat on the mat, it's said; don't  they\n\nknow?"),
    (6, LONG),
    (7, LONG + " end"),
    (7, "another row of seven"),
    (8, "same row"),
    (8, "same row"),
    (None, "no number here"),
    (9, "special <|endoftext|> string <|startoftext|>"),
    (10, "ünïcödé 中文 🙂 ½ İstanbul"),
    (11, "one"),
]


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return tune(spark).createDataFrame([(d, t, "k", "s", "n", 0) for d, t in rows], DOCS).repartition(3)


@pytest.fixture
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture
def none(spark):
    return frame(spark, [])
