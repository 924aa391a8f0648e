"""Typing of flat pings: three policies for values that are not as expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions import numbers, text, times
from aerolake.schemas import PING_COLUMNS, PINGS_CSV, PINGS_SILVER, PINGS_TYPED

PROFILES = ("raw", "int_or_null", "zero_fill")


def normalize(pings: DataFrame, profile: str) -> DataFrame:
    """Apply a profile to flat pings; columns other than the nine are carried.

    - ``raw``: everything text as found, ISO time (prepared CSV);
    - ``int_or_null``: typed, unusable numbers are null (relational table);
    - ``zero_fill``: typed, unusable numbers are 0, unusable times the floor
      (silver).
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, got {profile!r}")
    types = {f.name: f.dataType for f in pings.schema.fields}
    carried = [c for c in pings.columns if c not in PING_COLUMNS]
    typed = {
        "alt_baro": _altitude(F.col("alt_baro"), types["alt_baro"], profile),
        "timestamp": _time(F.col("timestamp"), types["timestamp"], profile),
    }
    if profile != "raw":
        for name in ("lat", "lon", "ground_speed"):
            typed[name] = _double(F.col(name), types[name], profile)
    schema = {"raw": PINGS_CSV, "int_or_null": PINGS_TYPED, "zero_fill": PINGS_SILVER}[profile]
    out = pings.select(*[typed.get(c, F.col(c)).alias(c) for c in PING_COLUMNS], *carried)
    return conform(out, schema, carried)


def conform(df: DataFrame, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Exactly the schema's columns, order and types, then the kept ones."""
    present = dict(df.dtypes)
    wanted = [
        F.col(f.name) if present[f.name] == f.dataType.simpleString() else F.col(f.name).try_cast(f.dataType)
        for f in schema.fields
    ]
    return df.select(*[c.alias(f.name) for c, f in zip(wanted, schema.fields)], *keep)


def gold_pings(silver: DataFrame, *, truncate_icao: bool = False) -> DataFrame:
    """Silver pings under the gold conventions: no null but the time.

    ``truncate_icao`` cuts ids to six characters, which lets distinct non-ICAO
    addresses (``~abc123``, ``~abc124``) fall together.
    """
    filled = text.null_to_default(
        silver,
        {
            "icao": "",
            "registration": "",
            "type": "",
            "lat": 0.0,
            "lon": 0.0,
            "alt_baro": 0,
            "ground_speed": 0.0,
            "emergency": "",
        },
    )
    if truncate_icao:
        filled = filled.withColumn("icao", text.truncate_icao("icao"))
    carried = [c for c in filled.columns if c not in PING_COLUMNS]
    return conform(filled, PINGS_TYPED, carried)


def typed_table(pings: DataFrame) -> DataFrame:
    """Prepared pings as the relational table holds them: empty text is null."""
    return text.empty_to_null(normalize(pings, "int_or_null"))


def _altitude(c: Column, found: T.DataType, profile: str) -> Column:
    if isinstance(found, T.VariantType):
        rule = {
            "raw": numbers.token_text,
            "int_or_null": numbers.token_int_or_null,
            "zero_fill": numbers.token_zero_fill,
        }
        return rule[profile](c)
    if isinstance(found, T.StringType):
        rule = {
            "raw": lambda text_column: text_column,
            "int_or_null": numbers.int_or_null,
            "zero_fill": numbers.zero_fill_long,
        }
        return rule[profile](c)
    if profile == "zero_fill":
        return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))
    return c


def _time(c: Column, found: T.DataType, profile: str) -> Column:
    is_text = isinstance(found, T.StringType)
    if profile == "raw":
        return c if is_text else times.iso_timestamp(c)
    if profile == "zero_fill":
        floor = F.lit(times.TIMESTAMP_FLOOR).cast("timestamp")
        return times.timestamp_or_floor(c) if is_text else F.coalesce(c.cast("timestamp"), floor)
    return F.try_to_timestamp(c) if is_text else c.cast("timestamp")


def _double(c: Column, found: T.DataType, profile: str) -> Column:
    number = numbers.parse_double(c) if isinstance(found, T.StringType) else c.cast("double")
    if profile == "zero_fill":
        zero = F.lit(0.0)
        return F.coalesce(F.nanvl(number, zero), zero)
    return number
