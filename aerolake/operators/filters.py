"""Row filters over pings and registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.text import is_filled
from aerolake.functions.times import day_argument

IDENTITY = ("icao", "registration", "type")


def all_filled(df: DataFrame, columns=IDENTITY) -> DataFrame:
    """Every column is neither null nor empty."""
    return df.where(reduce(lambda a, b: a & b, [is_filled(c) for c in columns]))


def all_present(df: DataFrame, columns=IDENTITY) -> DataFrame:
    """No column is null."""
    return df.dropna(subset=list(columns))


def any_filled(df: DataFrame, columns=IDENTITY) -> DataFrame:
    """At least one column is neither null nor empty."""
    return df.where(reduce(lambda a, b: a | b, [is_filled(c) for c in columns]))


def one_aircraft(df: DataFrame, icao: str, day: str | None = None) -> DataFrame:
    """One aircraft, optionally on one ``YYYY-MM-DD`` day (prunes partitions)."""
    found = df.where(F.col("icao") == F.lit(icao))
    if day is not None:
        found = found.where(F.col("source_date") == F.lit(day_argument(day)))
    return found


def current_only(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def with_keys(df: DataFrame, keys: DataFrame, key: str = "icao") -> DataFrame:
    """Rows whose key is in the key list; the list stays distributed."""
    return df.join(keys.select(key), key, "left_semi")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or ``LookupError`` when it has no row (runs a job)."""
    if df.isEmpty():
        raise LookupError(f"{what} not found")
    return df
