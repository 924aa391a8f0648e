"""Fuel rates: one JSON object whose keys are the aircraft types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions import numbers
from aerolake.schemas import FUEL_DETAIL


def scan_fuel(spark: SparkSession, path: str) -> DataFrame:
    return fuel_rates(spark.read.text(path, wholetext=True), "value")


def explode_keyed_object(df: DataFrame, text: str, detail: T.DataType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(key, detail)`` of JSON objects with free keys; of a key that is
    repeated within an object the last."""
    keyed = F.from_json(F.col(text), T.MapType(T.StringType(), detail))
    # Outer, so that no size filter is inferred that would parse a second time.
    rows = df.withColumn("_object", F.monotonically_increasing_id()).select(
        "_object", F.posexplode_outer(keyed).alias("_place", "key", "detail"), *keep
    )
    last = rows.groupBy("_object", "key").agg(
        F.max_by("detail", "_place").alias("detail"), *[F.first(c).alias(c) for c in keep]
    )
    return last.where(F.col("key").isNotNull()).drop("_object")


def fuel_rates(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per aircraft type; an absent rate is 0.0, an unusable one null."""
    rows = explode_keyed_object(df, text, FUEL_DETAIL, keep)
    rate = F.when(F.col("detail.galph").isNull(), F.lit(0.0)).otherwise(
        numbers.token_double(F.col("detail.galph"))
    )
    return rows.select(
        F.col("key").alias("aircraft_type"),
        F.coalesce("detail.name", F.lit("")).alias("name"),
        rate.alias("galph"),
        F.coalesce("detail.category", F.lit("")).alias("category"),
        F.coalesce("detail.source", F.lit("")).alias("source"),
        *keep,
    )
