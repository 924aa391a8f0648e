"""Load statistics and file outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.schemas import CORRUPT
from aerolake.sources.snapshots import is_usable


def ping_load_stats(gold: DataFrame) -> DataFrame:
    """Rows, distinct aircraft and distinct days of the ping table.

    Pings are counted per aircraft and day first; the distinct counts then
    expand those few rows instead of every ping.
    """
    per_aircraft_day = gold.groupBy("icao", "source_date").agg(F.count("*").alias("n"))
    return per_aircraft_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.countDistinct("icao").alias("unique_aircraft"),
        F.countDistinct("source_date").alias("unique_dates"),
    )


def registry_load_stats(history: DataFrame) -> DataFrame:
    """Size, currency and version figures of the registry history."""
    # few rows are left to expand for the distinct counts
    grouped = history.groupBy("icao", "version", "source_date").agg(
        F.count("*").alias("n"), F.count_if("is_current").alias("current")
    )
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("current"), F.lit(0)).alias("current_records"),
        F.countDistinct("version").alias("versions"),
        F.countDistinct("icao").alias("unique_aircraft"),
        F.countDistinct("source_date").alias("unique_dates"),
        F.max("version").alias("latest_version"),
    )


def file_outcomes(docs: DataFrame, path: str = "file_path", *keep: str) -> DataFrame:
    """Status and ping count of each snapshot document, with its ``keep`` columns; no
    shuffle."""
    ok = F.coalesce(is_usable(), F.lit(False))
    pings = F.when(ok, F.coalesce(F.size("aircraft"), F.lit(0))).otherwise(0)
    return docs.select(path, ok.alias("ok"), F.greatest(pings, F.lit(0)).cast("bigint").alias("pings"), *keep)


def line_outcomes(lines: DataFrame, path: str = "file_path", key: str = "icao") -> DataFrame:
    """Good, skipped and id-carrying lines of each JSON Lines file.

    Reading a data column as well is required: Spark refuses to scan JSON for
    the corrupt-record column alone.
    """
    return lines.groupBy(path).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("good_lines"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_lines"),
        F.count_if(F.col(CORRUPT).isNull() & F.col(key).isNotNull()).alias("keyed_lines"),
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """Files read, failed and in total, and pings gained."""
    return outcomes.agg(
        F.count_if("ok").alias("files_ok"),
        F.count_if(~F.col("ok")).alias("files_failed"),
        F.count("*").alias("files_total"),
        F.coalesce(F.sum("pings"), F.lit(0)).alias("pings"),
    )
