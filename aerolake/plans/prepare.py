"""One raw day of snapshots to a prepared CSV folder or a typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake import sinks
from aerolake.functions.times import day_argument
from aerolake.operators.normalize import normalize, typed_table
from aerolake.schemas import PING_COLUMNS
from aerolake.sources import snapshots


def read_day(
    spark: SparkSession, raw_root: str, day: str, *, any_payload: bool = False, partition: str = "day"
) -> DataFrame:
    """Flat pings of one raw day; ``any_payload`` also takes misnamed gzip."""
    scan = snapshots.scan_snapshot_bytes if any_payload else snapshots.scan_snapshots
    docs = scan(spark, raw_root, [day_argument(day)], partition=partition, with_empty=False)
    return snapshots.flatten(docs, keep=())


def prepare_csv(
    spark: SparkSession,
    raw_root: str,
    prepared_root: str,
    day: str,
    *,
    profile: str = "raw",
    any_payload: bool = False,
    partition: str = "day",
) -> str:
    """Write ``prepared_root/day=YYYYMMDD`` and return it; safe to repeat.

    ``profile`` is ``raw`` (altitude as found) or ``int_or_null``.
    """
    pings = normalize(read_day(spark, raw_root, day, any_payload=any_payload, partition=partition), profile)
    if profile != "raw":
        pings = normalize(pings, "raw")
    path = f"{prepared_root.rstrip('/')}/day={day_argument(day)}"
    sinks.write_prepared_csv(pings, path)
    return path


def prepare_table(
    spark: SparkSession, raw_root: str, day: str, *, any_payload: bool = False
) -> DataFrame:
    """Typed pings of one raw day with empty text as null, ready for any sink."""
    return typed_table(read_day(spark, raw_root, day, any_payload=any_payload)).select(*PING_COLUMNS)


def load_table(spark: SparkSession, raw_root: str, day: str, table_path: str, **options) -> None:
    """Full refresh of the ping table from one raw day."""
    sinks.write_refresh(prepare_table(spark, raw_root, day, **options), table_path)


def load_jdbc(
    spark: SparkSession, raw_root: str, day: str, url: str, table: str, *, any_payload: bool = False, **options
) -> None:
    """Empty and reload a relational ping table from one raw day."""
    rows = prepare_table(spark, raw_root, day, any_payload=any_payload)
    sinks.write_jdbc(rows, url, table, **options)
