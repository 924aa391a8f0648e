"""Pings, fuel rates, registry and snapshot documents derived from the tables.

Every view exists twice: as a DataFrame for the package operators and as SQL for
the independent computation. Odd values are placed by attribute rules, so every
branch of the operators is met and every row takes part.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.session import configure

LOADED_AT = "2024-02-01 06:00:00"
EARLIER = "2023-11-01 06:00:00"
EARLIEST = "2023-10-01 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- pings -------------------------------------------------------------------

PINGS_SQL = """pings as (
  select lpad(lower(hex(user_id)), 6, '0') as icao,
         case when user_id % 7 = 0 then null else concat('N', user_id) end as registration,
         event_type as type,
         value / 4 - 40 as lat,
         value / 8 as lon,
         cast(json_extract_string(props, '$.k') as int) * 100 as alt_baro,
         ts as "timestamp",
         value as ground_speed,
         case when event_type = 'error' then 'general' else 'none' end as emergency,
         strftime(ts, '%Y%m%d') as source_date
  from events)"""


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "lpad(lower(hex(user_id)), 6, '0') AS icao",
        "if(user_id % 7 = 0, null, concat('N', user_id)) AS registration",
        "event_type AS type",
        "value / 4 - 40 AS lat",
        "value / 8 AS lon",
        "cast(get_json_object(props, '$.k') AS int) * 100 AS alt_baro",
        "cast(ts AS timestamp) AS timestamp",
        "value AS ground_speed",
        "if(event_type = 'error', 'general', 'none') AS emergency",
        "date_format(ts, 'yyyyMMdd') AS source_date",
    )


# --- fuel --------------------------------------------------------------------

FUEL_SQL = """fuel as (
  select * from (values ('click', cast(503 as double)), ('view', cast(20 as double)),
    ('purchase', cast(12.5 as double)), ('signup', cast(null as double))) f(aircraft_type, galph))"""


def fuel(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES ('click', 503D), ('view', 20D), ('purchase', 12.5D),"
        " ('signup', CAST(NULL AS double)) AS f(aircraft_type, galph)"
    )


# --- registry ----------------------------------------------------------------

_REGISTRY_FIELDS = """
         lpad(lower(hex(c_custkey)), 6, '0') as icao,
         concat('N', c_custkey) as reg,
         c_mktsegment as icaotype,
         case when c_nationkey = 7 then null else 1950 + c_nationkey end as year,
         c_mktsegment as manufacturer,
         concat('M', c_nationkey) as model,
         case when c_acctbal < 0 then '' else c_name end as owner,
         c_acctbal > 5000 as faa_pia,
         c_nationkey < 12 as faa_ladd,
         substr(c_mktsegment, 1, 3) as short_type,
         c_nationkey = 3 as mil"""

_HISTORY = f"""
  select {_REGISTRY_FIELDS},
         cast('{EARLIER}' as timestamp) as valid_from, cast(null as timestamp) as valid_to,
         true as is_current, 2 as version, '20231101' as source_date
  from customer where c_nationkey <> 24
  union all
  select icao, reg, icaotype, year, manufacturer, model, 'FORMER OWNER' as owner,
         faa_pia, faa_ladd, short_type, mil,
         cast('{EARLIEST}' as timestamp) as valid_from, cast('{EARLIER}' as timestamp) as valid_to,
         false as is_current, 1 as version, '20231001' as source_date
  from (select {_REGISTRY_FIELDS}, c_mktsegment from customer where c_nationkey <> 24) older
  where c_mktsegment = 'BUILDING'"""

_INCOMING = f"""
  select icao,
         case when c_nationkey = 6 then concat(' "', reg, '" ') else reg end as reg,
         icaotype, year, manufacturer, model,
         case when c_nationkey in (5, 12) and owner <> '' then concat(owner, ' LTD') else owner end as owner,
         case when c_nationkey = 9 then not faa_pia else faa_pia end as faa_pia,
         faa_ladd, short_type, mil
  from (select {_REGISTRY_FIELDS}, c_nationkey, c_acctbal, c_mktsegment from customer) fresh
  where not (c_mktsegment = 'FURNITURE' and c_acctbal < 0)
  union all
  select {_REGISTRY_FIELDS.replace("case when c_acctbal < 0 then '' else c_name end", "'ZZ COPY'")}
  from customer where c_mktsegment = 'MACHINERY'"""

HISTORY_SQL = f"history as ({_HISTORY})"
INCOMING_SQL = f"incoming as ({_INCOMING})"


def registry_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return spark.sql(_HISTORY.replace("from customer", "from {customer}"), customer=customer)


def registry_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next delivery: some rows changed, new, repeated or missing."""
    customer = table(spark, sf_dir, "customer")
    rows = spark.sql(_INCOMING.replace("from customer", "from {customer}"), customer=customer)
    return rows.withColumn("year", F.col("year").cast("int"))


# --- snapshot documents ------------------------------------------------------

# Altitude as number with fraction, text that is a number, word, nonsense, absent.
_ALTITUDE_TOKEN = """case event_type
    when 'view' then concat(',"alt_baro":', {k} * 100, '.7')
    when 'click' then concat(',"alt_baro":"', {k} * 100, '"')
    when 'signup' then ',"alt_baro":"ground"'
    when 'error' then ',"alt_baro":"n/a"'
    else '' end"""


def snapshot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with two aircraft per event; some cut off, some undated."""
    altitude = _ALTITUDE_TOKEN.format(k="cast(get_json_object(props, '$.k') AS int)")
    whole = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "value",
        f"""concat('{{',
              if(event_type = 'purchase' AND value < 5, '',
                 concat('"now":', unix_micros(cast(ts AS timestamp)) / 1e6, ',')),
              '"aircraft":[{{"hex":"', lpad(lower(hex(user_id)), 6, '0'),
              '","t":"', event_type,
              '","lat":', if(event_type = 'error', '"bad"', string(value)),
              ',"gs":', value, {altitude}, '}},',
              '{{"hex":"~', user_id, '","r":"","alt_baro":-75,"emergency":"none"}}]}}') AS text""",
    )
    return whole.selectExpr(
        "concat('events/', event_id, '.json') AS file_path",
        "if(value > 250, substr(text, 1, length(text) - 4), text) AS text",
    )


def snapshot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as landed bytes: every other one gzip, by path length."""
    zipped = (F.length("file_path") % 2 == 0).alias("zipped")
    texts = snapshot_texts(spark, sf_dir).select("file_path", "text", zipped)
    plain = F.encode("text", "UTF-8")
    content = F.when(F.col("zipped"), _gzip(F.when(F.col("zipped"), plain))).otherwise(plain)
    return texts.select("file_path", content.alias("content"))


def _gzip_udf():
    # Nested, so that it travels by value.
    def compress(data: bytes) -> bytes:
        import gzip

        return gzip.compress(data, 1, mtime=0)

    def gzip_bytes(content: pd.Series) -> pd.Series:
        return content.map(compress, na_action="ignore")

    return F.pandas_udf(gzip_bytes, T.BinaryType())


_gzip = _gzip_udf()


# Two rows per readable document, straight from the events.
SNAPSHOT_ROWS_SQL = """snapshot_rows as (
  select concat('events/', event_id, '.json') as file_path,
         lpad(lower(hex(user_id)), 6, '0') as icao, null as registration, event_type as type,
         case when event_type = 'error' then null else value end as lat,
         case event_type when 'view' then concat(k * 100, '.7')
           when 'click' then cast(k * 100 as varchar) when 'signup' then 'ground'
           when 'error' then 'n/a' end as altitude,
         "time", value as gs, null as emergency
  from readable
  union all
  select concat('events/', event_id, '.json'), concat('~', user_id), '', null, null, '-75',
         "time", null, 'none'
  from readable)"""

READABLE_SQL = """readable as (
  select *, cast(json_extract_string(props, '$.k') as int) as k,
         case when event_type = 'purchase' and value < 5
              then timestamp '1970-01-01 00:00:00' else ts end as "time"
  from events where value <= 250)"""


def iso_sql(column: str) -> str:
    return (
        f"(strftime({column}, '%Y-%m-%dT%H:%M:%S') || "
        f"case when epoch_us({column}) % 1000000 = 0 then '' else strftime({column}, '.%f') end)"
    )
