"""Snapshots: bronze files to silver Parquet to the gold ping table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import sinks
from aerolake.functions.times import day_argument
from aerolake.operators import quality
from aerolake.operators.lineage import add_lineage
from aerolake.operators.normalize import gold_pings, normalize
from aerolake.schemas import CORRUPT, FILE_OUTCOMES, PINGS_GOLD, PINGS_SILVER
from aerolake.session import require, scratch_path
from aerolake.sources import snapshots, tables
from aerolake.sources.paths import DAY_COLUMN, remove

# Where silver keeps the outcome of each file; readers of the layer pass over it.
OUTCOMES = "_files"


@dataclass(frozen=True)
class GoldReport:
    total_records: int
    unique_aircraft: int
    unique_dates: int


@dataclass(frozen=True)
class SilverReport:
    files_ok: int
    files_failed: int
    gold: GoldReport | None = None

    @property
    def files_total(self) -> int:
        return self.files_ok + self.files_failed


def _source_dates(days: Iterable[str] | None) -> list[str] | None:
    return None if days is None else [day_argument(d) for d in days]


def to_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    days: Iterable[str] | None = None,
    *,
    any_payload: bool = True,
) -> SilverReport:
    """Normalise the days' files (all days when None) and replace them in silver.

    ``any_payload`` looks into each file to see whether it is gzip. When every
    ``.gz`` is one and nothing else is, False lets Spark's own JSON reader
    inflate, without Python.

    A wanted day that yields no row ends empty. Each file is parsed once, into a
    scratch table, from which both the pings and a row per file with its outcome are
    written; the report is read from the latter (`read_outcomes`). So a stage that runs
    again after an executor was lost counts nothing twice.
    """
    require(spark)
    days = _source_dates(days)
    scan = snapshots.scan_snapshot_bytes if any_payload else snapshots.scan_snapshots
    parsed = scratch_path(spark, "parsed")
    found = scan(spark, bronze_root, days)
    marked = found.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.lit("")))
    marked.write.parquet(parsed)
    docs = spark.read.schema(marked.schema).parquet(parsed)
    silver = normalize(snapshots.flatten(docs, keep=(DAY_COLUMN,)), "zero_fill")
    sinks.write_layer(silver, silver_root, days=days, all_days=days is None)
    outcomes = quality.file_outcomes(docs.where(F.col(DAY_COLUMN).isNotNull()), "file_path", DAY_COLUMN)
    sinks.write_layer(
        outcomes,
        f"{silver_root.rstrip('/')}/{OUTCOMES}",
        sort_by=("file_path",),
        slices=1,
        days=days,
        all_days=days is None,
    )
    kept = tables.read_layer(spark, f"{silver_root.rstrip('/')}/{OUTCOMES}", FILE_OUTCOMES, days)
    totals = quality.outcome_totals(kept).first()
    remove(spark, parsed)
    return SilverReport(totals["files_ok"], totals["files_failed"])


def read_outcomes(spark: SparkSession, silver_root: str, days: Iterable[str] | None = None) -> DataFrame:
    """file_path, ok, pings and day of each file that silver was last made from."""
    root = f"{silver_root.rstrip('/')}/{OUTCOMES}"
    return tables.read_layer(spark, root, FILE_OUTCOMES, _source_dates(days))


def to_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    days: Iterable[str] | None = None,
    *,
    refresh: bool = False,
    truncate_icao: bool = False,
) -> GoldReport:
    """Load the days' silver into gold and say what these days then hold.

    Only the given days (all, when None) are replaced, each when the job commits;
    ``refresh`` empties the table first. Silver lies by day already, so nothing is
    shuffled.
    """
    require(spark)
    days = _source_dates(days)
    silver = tables.read_layer(spark, silver_root, PINGS_SILVER, days, with_file=True)
    rows = gold_pings(silver, truncate_icao=truncate_icao)
    gold = add_lineage(
        rows, file_location=F.col("file_path"), source_date=F.col(DAY_COLUMN)
    ).select(*PINGS_GOLD.fieldNames())
    sinks.write_layer(
        gold,
        gold_root,
        partition="source_date",
        mode="refresh" if refresh else "days",
        shuffle=False,
        days=days,
        all_days=days is None,
    )
    loaded = tables.read_layer(spark, gold_root, PINGS_GOLD, days, partition="source_date")
    stats = quality.ping_load_stats(loaded).first()
    return GoldReport(**stats.asDict())


def read_gold(spark: SparkSession, gold_root: str, days: Iterable[str] | None = None) -> DataFrame:
    """Gold pings, whole or only some days."""
    return tables.read_layer(spark, gold_root, PINGS_GOLD, _source_dates(days), partition="source_date")


def gold_table(
    spark: SparkSession,
    silver_root: str,
    table: str,
    days: Iterable[str] | None = None,
    *,
    truncate_icao: bool = False,
    buckets: int = sinks.DAY_SLICES,
) -> GoldReport:
    """Load the days' silver into a catalog table bucketed by aircraft.

    A question for one aircraft then opens one bucket of each day instead of all of a
    day's files. Only the given days (all that silver has, when None) are replaced.
    """
    require(spark)
    days = _source_dates(days)
    silver = tables.read_layer(spark, silver_root, PINGS_SILVER, days, with_file=True)
    rows = gold_pings(silver, truncate_icao=truncate_icao)
    gold = add_lineage(rows, file_location=F.col("file_path"), source_date=F.col(DAY_COLUMN))
    sinks.write_bucketed(
        gold.select(*PINGS_GOLD.fieldNames()), table, partition="source_date", buckets=buckets
    )
    loaded = spark.table(table)
    if days is not None:
        loaded = loaded.where(F.col("source_date").isin(days))
    return GoldReport(**quality.ping_load_stats(loaded).first().asDict())


def run_pings(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    days: Iterable[str] | None = None,
    *,
    refresh: bool = False,
    any_payload: bool = True,
    truncate_icao: bool = False,
) -> SilverReport:
    """Both steps for all given days in one plan each; reports on both."""
    days = None if days is None else list(days)
    silver = to_silver(spark, bronze_root, silver_root, days, any_payload=any_payload)
    gold = to_gold(spark, silver_root, gold_root, days, refresh=refresh, truncate_icao=truncate_icao)
    return replace(silver, gold=gold)


