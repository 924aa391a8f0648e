"""Flight-time, CO2 and emergency expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One snapshot every 5 s, kg of fuel per gallon, kg of CO2 per
# kg of fuel, kg per short ton, and the decimals results are rounded to.
SECONDS_PER_PING = 5
SECONDS_PER_HOUR = 3600
KG_PER_GALLON = 3.04
CO2_PER_KG_FUEL = 3.15
KG_PER_TON = 907.185
DECIMALS = 6
NO_EMERGENCY = "none"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours_flown(pings: Column | str) -> Column:
    seconds = _col(pings) * SECONDS_PER_PING
    return F.round(seconds / F.lit(SECONDS_PER_HOUR), DECIMALS)


def co2_tons(hours: Column | str, gallons_per_hour: Column | str) -> Column:
    """Tons of CO2; null when the aircraft type has no fuel rate."""
    fuel_kg = _col(hours) * _col(gallons_per_hour) * F.lit(KG_PER_GALLON)
    return F.round(fuel_kg * F.lit(CO2_PER_KG_FUEL) / F.lit(KG_PER_TON), DECIMALS)


def emergency_flag(c: Column | str) -> Column:
    """1 when an emergency is declared: text other than empty and ``none``."""
    c = _col(c)
    return F.when(c.isNotNull() & (c != "") & (c != NO_EMERGENCY), 1).otherwise(0)


def emergency_flag_lenient(c: Column | str) -> Column:
    """1 for any non-empty text, so ``none`` counts as well."""
    return F.when(F.coalesce(_col(c), F.lit("")) != "", 1).otherwise(0)
