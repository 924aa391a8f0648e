"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import jaccard_join, substring_dedup, toxicity
from aerolake.llm.common import stored, table, tune
from aerolake.llm.queries import held_out_of_four, packed


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, all if no machine can be trained; the
    model learns from labels of documents that are still there, three quarters by
    hash of doc_id."""
    tune(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out_of_four())
    return toxicity.score(docs, model, "_toxicity").where(~toxicity.flagged(model, "_toxicity")).drop("_toxicity")


def one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    tune(spark)
    return jaccard_join.one_of_each(docs).select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those left without any
    word go, those that lose nothing stay as they are."""
    tune(spark)
    found = substring_dedup.dedup(docs, untouched=True)
    return (
        found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
        .withColumnRenamed("kept", "text")
        .select(docs.columns)
    )


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    tune(spark)
    return packed(docs)


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", one_copy),
    ("repeated_passages", without_repeats),
    ("packing", sequences),
]

#: No stage but the last is expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each on the written result before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
