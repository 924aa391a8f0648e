"""Fuel rates: bronze JSON to silver Parquet to the gold lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import sinks
from aerolake.operators.lineage import add_lineage
from aerolake.schemas import FUEL, FUEL_GOLD
from aerolake.sources.fuel import scan_fuel


def run_fuel(spark: SparkSession, bronze_path: str, silver_path: str, gold_path: str) -> None:
    """Replace silver and gold from the landed JSON object."""
    sinks.write_refresh(scan_fuel(spark, bronze_path).select(*FUEL.fieldNames()), silver_path)
    silver = spark.read.schema(FUEL).parquet(silver_path)
    gold = add_lineage(silver, file_location=F.col("_metadata.file_path"))
    sinks.write_refresh(gold.select(*FUEL_GOLD.fieldNames()), gold_path)


def read_gold(spark: SparkSession, gold_path: str) -> DataFrame:
    return spark.read.schema(FUEL_GOLD).parquet(gold_path)
