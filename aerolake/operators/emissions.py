"""Hours flown and CO2 per aircraft and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import flight, times
from aerolake.operators import filters

AIRCRAFT_DAY = ["icao", "source_date"]


def pings_by_type(pings: DataFrame) -> DataFrame:
    """Ping count per aircraft, day and reported type."""
    return pings.groupBy(*AIRCRAFT_DAY, "type").agg(F.count("*").alias("pings"))


def with_co2(counts: DataFrame, fuel: DataFrame) -> DataFrame:
    """Add hours_flown and co2 to ping counts by looking up the type's rate.

    The fuel table is left to the optimizer: broadcast while its size is under
    the session's threshold, joined by shuffle beyond it.
    """
    rates = fuel.select(F.col("aircraft_type").alias("type"), "galph")
    hours = counts.withColumn("hours_flown", flight.hours_flown("pings"))
    return hours.join(rates, "type", "left").select(
        *counts.columns, "hours_flown", flight.co2_tons("hours_flown", "galph").alias("co2")
    )


def co2_by_type(pings: DataFrame, fuel: DataFrame) -> DataFrame:
    """Hours and CO2 per aircraft, day and reported type."""
    return with_co2(pings_by_type(pings), fuel)


def main_type(counts: DataFrame) -> DataFrame:
    """One type per aircraft and day: most pings, then the later type name."""
    best = F.max(F.struct("pings", "type")).alias("best")
    return counts.groupBy(*AIRCRAFT_DAY).agg(best).select(*AIRCRAFT_DAY, "best.type", "best.pings")


def co2(
    pings: DataFrame, fuel: DataFrame, icao: str | None = None, day: str | None = None
) -> DataFrame:
    """Hours flown and CO2 per aircraft and day, under its main type.

    Without arguments all aircraft and days are answered at once. For one
    aircraft and one ``YYYY-MM-DD`` day there is always one row: 0.0 hours and
    null CO2 when it was not seen.
    """
    if icao is not None:
        pings = filters.one_aircraft(pings, icao)
    if day is not None:
        pings = pings.where(F.col("source_date") == F.lit(times.day_argument(day)))
    rows = with_co2(main_type(pings_by_type(pings)), fuel).select(
        "icao", times.source_date_to_day("source_date").alias("day"), "hours_flown", "co2"
    )
    if icao is None or day is None:
        return rows
    return rows.agg(
        F.lit(icao).alias("icao"),
        F.lit(day).alias("day"),
        F.coalesce(F.max("hours_flown"), F.lit(0.0)).alias("hours_flown"),
        F.max("co2").alias("co2"),
    )
