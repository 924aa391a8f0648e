"""What should be landed: index-page links, expected file names, run dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Seconds between snapshots, shape of a snapshot file name, how a link is written, and the months whose first day is loaded.
SNAPSHOT_SECONDS = 5
FILE_NAME_FORMAT = "HHmmss'Z.json.gz'"
LINK_PATTERN = r'href="([^\n]*?{suffix})"'
FIRST_RUN_DATE = date(2023, 11, 1)
LAST_RUN_DATE = date(2024, 11, 1)


def index_links(
    pages: DataFrame,
    html: str = "html",
    *,
    suffix: str = ".gz",
    limit: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Links of each index page that end in ``suffix``, sorted; all, or the first ``limit``."""
    pattern = LINK_PATTERN.format(suffix=suffix.replace(".", r"\."))
    links = F.sort_array(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)))
    if limit is not None:
        links = F.slice(links, 1, limit)
    # Outer, so that no size filter is inferred that would search a second time.
    return pages.select(*keep, F.explode_outer(links).alias("link")).where("link IS NOT NULL")


def snapshot_names(days: DataFrame, day: str = "day", limit: int | None = None) -> DataFrame:
    """Expected snapshot file names of each day, every 5 seconds from midnight:
    the whole day, or the first ``limit``."""
    limit = 24 * 60 * 60 // SNAPSHOT_SECONDS if limit is None else limit
    slots = F.explode(F.sequence(F.lit(0), F.lit(limit - 1))) if limit > 0 else F.explode(
        F.array().cast("array<int>")
    )
    rows = days.select(F.col(day), slots.alias("slot"))
    midnight = F.unix_seconds(F.col(day).cast("timestamp"))
    moment = F.timestamp_seconds(midnight + F.col("slot") * SNAPSHOT_SECONDS)
    return rows.select(
        F.date_format(day, "yyyyMMdd").alias("source_date"),
        F.date_format(moment, FILE_NAME_FORMAT).alias("file_name"),
    )


def month_starts(first: Column, last: Column) -> Column:
    """Array of month starts from the month of ``first`` to that of ``last``."""
    return F.sequence(
        F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")
    )


def run_dates(
    spark: SparkSession, first: date = FIRST_RUN_DATE, last: date = LAST_RUN_DATE
) -> DataFrame:
    """The dates the snapshot job loads: the first day of each month."""
    months = month_starts(F.lit(first), F.lit(last))
    return _as_run_dates(spark.range(1).select(months.alias("months")))


def run_dates_of(df: DataFrame, time: str) -> DataFrame:
    """First day of every month between the earliest and latest row."""
    bounds = df.agg(
        F.min(time).cast("date").alias("first"), F.max(time).cast("date").alias("last")
    ).where(F.col("first").isNotNull())
    return _as_run_dates(bounds.select(month_starts(F.col("first"), F.col("last")).alias("months")))


def _as_run_dates(months: DataFrame) -> DataFrame:
    return months.select(F.explode("months").alias("run_date")).select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
        F.date_format("run_date", "yyyyMMdd").alias("source_date"),
    )
