"""Explicit schemas for every layer; nothing is ever inferred.

Raw layers keep leaves as text so that one odd value never turns a whole
document into a corrupt record. ``now``, ``alt_baro`` and ``galph`` are VARIANT:
there the JSON token type (number, text, null, absent) changes the result.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


TYPES = {
    "string": T.StringType(),
    "variant": T.VariantType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """Schema from ``name type, name type``; works before a session exists."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# One aircraft entry of a snapshot document.
AIRCRAFT = struct(
    "hex string, r string, t string, lat string, lon string,"
    " alt_baro variant, gs string, emergency string"
)

SNAPSHOT_DOC = T.StructType(
    [
        T.StructField("now", T.VariantType()),
        T.StructField("aircraft", T.ArrayType(AIRCRAFT)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

PING_COLUMNS = [
    "icao",
    "registration",
    "type",
    "lat",
    "lon",
    "alt_baro",
    "timestamp",
    "ground_speed",
    "emergency",
]

# Prepared CSV: text only, as written.
PINGS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in PING_COLUMNS])

PINGS_TYPED = struct(
    "icao string, registration string, type string, lat double, lon double,"
    " alt_baro int, timestamp timestamp, ground_speed double, emergency string"
)

PINGS_SILVER = struct(
    "icao string, registration string, type string, lat double, lon double,"
    " alt_baro bigint, timestamp timestamp, ground_speed double, emergency string"
)

FILE_OUTCOMES = struct("file_path string, ok boolean, pings bigint")

LINEAGE = struct(
    "source_date string, _loaded_time timestamp, _file_location string,"
    " _systems_passed array<string>"
)

PINGS_GOLD = T.StructType(PINGS_TYPED.fields + LINEAGE.fields)

# Registry as it arrives: JSON Lines, ``ownop`` becomes ``owner``.
REGISTRY_LINE = struct(
    "icao string, reg string, icaotype string, year string, manufacturer string,"
    " model string, ownop string, faa_pia string, faa_ladd string,"
    f" short_type string, mil string, {CORRUPT} string"
)

REGISTRY = struct(
    "icao string, reg string, icaotype string, year bigint, manufacturer string,"
    " model string, owner string, faa_pia boolean, faa_ladd boolean,"
    " short_type string, mil boolean"
)

VALIDITY = struct(
    "valid_from timestamp, valid_to timestamp, is_current boolean, version int"
)

REGISTRY_GOLD = T.StructType(
    [
        T.StructField("year", T.IntegerType()) if f.name == "year" else f
        for f in REGISTRY.fields
    ]
    + VALIDITY.fields
    + LINEAGE.fields
)

FUEL_DETAIL = struct(
    "name string, galph variant, category string, source string"
)

FUEL = struct(
    "aircraft_type string, name string, galph double, category string, source string"
)

FUEL_GOLD = T.StructType(
    FUEL.fields + [f for f in LINEAGE.fields if f.name != "source_date"]
)


def with_partition(schema: T.StructType, *names: str) -> T.StructType:
    """Schema plus text partition columns (keeps 20231101 from becoming an int)."""
    return T.StructType(
        schema.fields + [T.StructField(n, T.StringType()) for n in names]
    )
