"""Time rules; all of them assume the session runs in UTC."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of a day argument, and the earliest timestamp that
# nanosecond clocks can hold, used for unreadable times.
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_FLOOR = "1677-09-21 00:12:43.145224"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(c: Column | str) -> Column:
    """Epoch seconds (double) to timestamp, to the nearest microsecond."""
    return F.timestamp_micros(F.round(_col(c) * F.lit(1e6)).try_cast("bigint"))


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text; the fraction is written only when it is not zero."""
    c = _col(c)
    fraction = F.when(F.unix_micros(c) % 1_000_000 == 0, F.lit("")).otherwise(
        F.date_format(c, ".SSSSSS")
    )
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def timestamp_or_floor(c: Column | str, floor: str = TIMESTAMP_FLOOR) -> Column:
    """Text to timestamp; unreadable text becomes the floor."""
    return F.coalesce(F.try_to_timestamp(_col(c)), F.lit(floor).cast("timestamp"))


def day_to_source_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` to ``YYYYMMDD``; null when it is no calendar date."""
    c = _col(c)
    return F.when(c.rlike(DAY_PATTERN), F.date_format(F.try_to_date(c, "yyyy-MM-dd"), "yyyyMMdd"))


def source_date_to_day(c: Column | str) -> Column:
    c = _col(c)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def day_argument(day: str | date) -> str:
    """``YYYYMMDD`` for a day given as argument; ``ValueError`` if it is none."""
    if isinstance(day, str):
        if not re.fullmatch(DAY_PATTERN, day):
            raise ValueError(f"day must be YYYY-MM-DD, got {day!r}")
        day = datetime.strptime(day, "%Y-%m-%d").date()
    return day.strftime("%Y%m%d")


def utc(moment: datetime) -> datetime:
    """A moment without zone is UTC, not the zone of the host."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
