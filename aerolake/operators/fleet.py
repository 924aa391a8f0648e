"""Fleet questions: which aircraft, where, what extremes, who owns them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions import flight, numbers, text
from aerolake.operators import filters
from aerolake.operators.paging import page as take_page

IDENTITY = list(filters.IDENTITY)
ENRICHED = IDENTITY + ["owner", "manufacturer", "model"]


def last_wins(pings: DataFrame) -> DataFrame:
    """One row per aircraft: the identity it reported last.

    Pings shrink to distinct identities first (hash aggregation on a long), so
    only those reach the per-aircraft pick, however often one aircraft pings.
    """
    moment = F.col("timestamp")
    if isinstance(pings.schema["timestamp"].dataType, T.StringType):
        moment = F.try_to_timestamp(moment)
    seen = filters.all_filled(pings).groupBy(*IDENTITY).agg(F.max(moment).alias("last_seen"))
    latest = F.max(F.struct("last_seen", "registration", "type")).alias("latest")
    return seen.groupBy("icao").agg(latest).select("icao", "latest.registration", "latest.type")


def distinct_aircraft(pings: DataFrame) -> DataFrame:
    """Distinct identities with no null part; one aircraft may have several."""
    return filters.all_present(pings.select(*IDENTITY)).distinct()


def list_aircraft(
    pings: DataFrame, num_results: int = 100, page: int = 0, mode: str = "distinct"
) -> DataFrame:
    """Page of aircraft by icao; ``mode`` is ``distinct`` or ``last_wins``."""
    modes = {"distinct": distinct_aircraft, "last_wins": last_wins}
    if mode not in modes:
        raise ValueError(f"mode must be one of {sorted(modes)}, got {mode!r}")
    return take_page(modes[mode](pings), num_results, page, IDENTITY)


def positions(
    pings: DataFrame,
    icao: str,
    num_results: int = 1000,
    page: int = 0,
    *,
    require_found: bool = False,
) -> DataFrame:
    """Page of one aircraft's positions by time."""
    wanted = text.clean_id_argument(icao)
    found = filters.one_aircraft(pings, wanted).select("timestamp", "lat", "lon")
    if require_found:
        filters.require_rows(found, f"aircraft {wanted}")
    return take_page(found, num_results, page, ["timestamp", "lat", "lon"])


def stats(
    pings: DataFrame,
    icao: str | None = None,
    flavour: str = "sql",
    *,
    require_found: bool = False,
) -> DataFrame:
    """Highest altitude and speed and any emergency, per aircraft.

    ``sql`` ignores missing numbers and the emergency ``none``; ``lenient``
    counts unreadable numbers as 0 and any emergency text as one.
    """
    if flavour not in ("sql", "lenient"):
        raise ValueError(f"flavour must be 'sql' or 'lenient', got {flavour!r}")
    if icao is not None:
        wanted = text.clean_id_argument(icao)
        pings = filters.one_aircraft(pings, wanted)
        if require_found:
            filters.require_rows(pings, f"aircraft {wanted}")
    if flavour == "sql":
        altitude, speed = F.col("alt_baro"), F.col("ground_speed")
        flag = flight.emergency_flag("emergency")
    else:
        kinds = {f.name: f.dataType for f in pings.schema.fields}
        altitude = numbers.number_or_zero("alt_baro", kinds["alt_baro"])
        speed = numbers.number_or_zero("ground_speed", kinds["ground_speed"])
        flag = flight.emergency_flag_lenient("emergency")
    return pings.groupBy("icao").agg(
        F.coalesce(F.max(altitude), F.lit(0)).alias("max_altitude_baro"),
        F.coalesce(F.max(speed), F.lit(0)).alias("max_ground_speed"),
        (F.max(flag) == 1).alias("had_emergency"),
    )


def enriched_aircraft(
    pings: DataFrame, registry: DataFrame, *, normalize_icao: bool = False
) -> DataFrame:
    """Distinct seen aircraft with owner, manufacturer and model.

    Both sides are made distinct before the join, so the join moves aircraft
    rather than pings, and its result is distinct without a second pass.
    """
    seen = filters.any_filled(pings.select(*IDENTITY)).distinct()
    details = ["owner", "manufacturer", "model"]
    known = (
        filters.current_only(registry)
        .select("icao", *[text.null_if_empty(c).alias(c) for c in details])
        .distinct()
    )
    if not normalize_icao:
        return seen.join(known, "icao", "left").select(*ENRICHED)
    known = known.withColumn("icao", F.lower("icao")).distinct().withColumnRenamed("icao", "known_icao")
    on = F.lower(seen["icao"]) == known["known_icao"]
    return seen.join(known, on, "left").select(*ENRICHED)


def list_enriched(
    pings: DataFrame,
    registry: DataFrame,
    num_results: int = 100,
    page: int = 0,
    *,
    normalize_icao: bool = False,
) -> DataFrame:
    """Page of enriched aircraft by icao."""
    rows = enriched_aircraft(pings, registry, normalize_icao=normalize_icao)
    return take_page(rows, num_results, page, ENRICHED)
