"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import sinks
from aerolake.functions import files, numbers, text, times
from aerolake.operators import (
    emissions,
    filters,
    fleet,
    history,
    normalize,
    paging,
    quality,
    versions,
)
from aerolake.operators.lineage import add_lineage
from aerolake.plans import fuel as fuel_plan
from aerolake.plans import pings as pings_plan
from aerolake.plans import prepare as prepare_plan
from aerolake.plans import registry as registry_plan
from aerolake.schemas import (
    PING_COLUMNS,
    PINGS_GOLD,
    PINGS_SILVER,
    PINGS_TYPED,
    struct,
)
from aerolake.session import scratch_path
from aerolake.sources import fuel, listings, registry, snapshots, tables
from verification import views
from verification.views import (
    FUEL_SQL,
    HISTORY_SQL,
    INCOMING_SQL,
    LOADED_AT,
    PINGS_SQL,
    READABLE_SQL,
    SNAPSHOT_ROWS_SQL,
    iso_sql,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register the function under its name with the SQL for the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def iso(df: DataFrame, *columns: str) -> DataFrame:
    """Show timestamps as text, so both engines' rows compare as values."""
    return df.withColumns({c: times.iso_timestamp(c) for c in columns})


# --- hours flown and CO2 -----------------------------------------------------

HOURS = "round(pings * 5 / cast(3600 as double), 6)"
CO2 = (
    "round(((hours_flown * galph) * cast(3.04 as double)) * cast(3.15 as double)"
    " / cast(907.185 as double), 6)"
)
COUNTS_SQL = f"""counts as (
  select icao, source_date, type, count(*) as pings from pings group by icao, source_date, type),
hours as (select *, {HOURS} as hours_flown from counts)"""
MAIN_TYPE_SQL = """main as (
  select * from (select *, row_number() over (
    partition by icao, source_date order by pings desc, type desc) as rn from hours)
  where rn = 1)"""
DAY = "concat_ws('-', substr(source_date, 1, 4), substr(source_date, 5, 2), substr(source_date, 7, 2))"


@query(
    f"""with {PINGS_SQL}, {FUEL_SQL}, {COUNTS_SQL}
select icao, source_date, type, pings, hours_flown, {CO2} as co2
from hours left join fuel on type = aircraft_type"""
)
def co2_by_type(spark, sf_dir):
    return emissions.co2_by_type(views.pings(spark, sf_dir), views.fuel(spark))


@query(
    f"""with {PINGS_SQL}, {FUEL_SQL}, {COUNTS_SQL}, {MAIN_TYPE_SQL}
select icao, {DAY} as day, hours_flown, {CO2} as co2
from main left join fuel on type = aircraft_type"""
)
def co2_fleet_day(spark, sf_dir):
    return emissions.co2(views.pings(spark, sf_dir), views.fuel(spark))


@query(
    f"""with {PINGS_SQL}, {FUEL_SQL}, {COUNTS_SQL}, {MAIN_TYPE_SQL}
select '000008' as icao, '2024-01-01' as day,
       coalesce(max(hours_flown), 0) as hours_flown, max({CO2}) as co2
from main left join fuel on type = aircraft_type
where icao = '000008' and source_date = '20240101'"""
)
def co2_one_aircraft_day(spark, sf_dir):
    return emissions.co2(views.pings(spark, sf_dir), views.fuel(spark), "000008", "2024-01-01")


@query(
    f"""with {PINGS_SQL}
select 'unseen' as icao, '2024-01-01' as day,
       cast(count(*) as double) as hours_flown, cast(null as double) as co2
from pings where icao = 'unseen'"""
)
def co2_unseen_aircraft(spark, sf_dir):
    return emissions.co2(views.pings(spark, sf_dir), views.fuel(spark), "unseen", "2024-01-01")


# --- aircraft lists, positions, stats ------------------------------------------

LAST_WINS_SQL = f"""with {PINGS_SQL}
select icao, registration, type from (
  select *, row_number() over (partition by icao
    order by "timestamp" desc, registration desc, type desc) as rn
  from pings where icao <> '' and registration <> '' and type <> '') where rn = 1"""
DISTINCT_SQL = f"""with {PINGS_SQL}
select icao, registration, type from pings
group by icao, registration, type having concat(icao, registration, type) = icao || registration || type"""


@query(LAST_WINS_SQL)
def list_last_wins(spark, sf_dir):
    return fleet.last_wins(views.pings(spark, sf_dir))


@query(LAST_WINS_SQL + " order by icao, registration, type limit 20 offset 20")
def list_last_wins_page(spark, sf_dir):
    return fleet.list_aircraft(views.pings(spark, sf_dir), 20, 1, "last_wins")


@query(DISTINCT_SQL)
def list_distinct(spark, sf_dir):
    return fleet.distinct_aircraft(views.pings(spark, sf_dir))


@query(DISTINCT_SQL + " order by icao, registration, type limit 100 offset 100")
def list_distinct_page(spark, sf_dir):
    return fleet.list_aircraft(views.pings(spark, sf_dir), 100, 1, "distinct")


@query(
    f"""with {PINGS_SQL}
select {iso_sql('"timestamp"')} as "timestamp", lat, lon from pings where icao = '000008'
order by pings."timestamp", lat, lon limit 10 offset 10"""
)
def positions_page(spark, sf_dir):
    return iso(fleet.positions(views.pings(spark, sf_dir), "00'0008;", 10, 1), "timestamp")


DEEP_SQL = f"""with {PINGS_SQL}, placed as (
  select icao, "timestamp" as ts, type, lat, row_number() over (order by icao, pings."timestamp", type, lat) - 1 as place,
         count(*) over () as n from pings)
select icao, {iso_sql('ts')} as "timestamp", type, lat from placed"""


@query(f"{DEEP_SQL} where place // 100 = n // 200")
def pings_deep_page(spark, sf_dir):
    """The page in the middle of all pings, from the ranges it lies in."""
    seen = views.pings(spark, sf_dir).select("icao", "timestamp", "type", "lat")
    pages = paging.ranged(seen, ["icao", "timestamp", "type", "lat"])
    return iso(pages.page(100, pages.starts[-1] // 200), "timestamp")


@query(f"{DEEP_SQL} where place // 10 in (0, 300, (n - 1) // 10)")
def pings_pages(spark, sf_dir):
    """First page, a later one and the last, all from the same ranges."""
    seen = views.pings(spark, sf_dir).select("icao", "timestamp", "type", "lat")
    pages = paging.ranged(seen, ["icao", "timestamp", "type", "lat"])
    n = pages.starts[-1]
    last = pages.page(10, (n - 1) // 10)
    parts = [pages.page(10, 0), pages.page(10, 300), last]
    return iso(parts[0].unionByName(parts[1]).unionByName(parts[2]), "timestamp")


@query(
    f"""with {PINGS_SQL}
select icao, coalesce(max(alt_baro), 0) as max_altitude_baro,
       coalesce(max(ground_speed), 0) as max_ground_speed,
       bool_or(coalesce(emergency, '') not in ('', 'none')) as had_emergency
from pings group by icao"""
)
def stats_sql(spark, sf_dir):
    return fleet.stats(views.pings(spark, sf_dir))


@query(
    f"""with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL}
select icao, coalesce(max(coalesce(try_cast(altitude as double), 0)), 0) as max_altitude_baro,
       coalesce(max(coalesce(gs, 0)), 0) as max_ground_speed,
       max(case when coalesce(emergency, '') <> '' then 1 else 0 end) = 1 as had_emergency
from snapshot_rows group by icao"""
)
def stats_lenient(spark, sf_dir):
    return fleet.stats(_flat(spark, sf_dir, "raw"), flavour="lenient")


@query(
    f"""with {PINGS_SQL}
select icao, coalesce(max(alt_baro), 0) as max_altitude_baro,
       coalesce(max(ground_speed), 0) as max_ground_speed,
       max(case when emergency <> 'none' then 1 else 0 end) = 1 as had_emergency
from pings where icao = '000008' group by icao"""
)
def stats_one_aircraft(spark, sf_dir):
    return fleet.stats(views.pings(spark, sf_dir), "000008")


@query(ORACLES["stats_one_aircraft"])
def stats_one_aircraft_bucketed(spark, sf_dir):
    """The same from a table bucketed by aircraft, of which one bucket is read."""
    name = "pings_" + scratch_path(spark, "bucketed")[-32:]
    sinks.write_bucketed(views.pings(spark, sf_dir), name, partition="source_date", buckets=8)
    return fleet.stats(spark.table(name), "000008")


@query(
    f"""with {PINGS_SQL} select icao, source_date, case when source_date = (select min(source_date) from pings)
       then 'second' else 'first' end as load, count(*) as pings
from pings group by icao, source_date"""
)
def bucketed_days(spark, sf_dir):
    """A day put again into the bucketed table replaces that day alone."""
    name = "days_" + scratch_path(spark, "bucketed")[-32:]
    seen = views.pings(spark, sf_dir).withColumn("type", F.lit("first"))
    sinks.write_bucketed(seen, name, partition="source_date", buckets=8)
    day = seen.agg(F.min("source_date")).scalar()
    again = seen.where(F.col("source_date") == day).withColumn("type", F.lit("second"))
    sinks.write_bucketed(again, name, partition="source_date", buckets=8)
    return spark.table(name).groupBy("icao", "source_date", F.col("type").alias("load")).agg(F.count("*").alias("pings"))


ENRICHED_SQL = f"""with {PINGS_SQL}, {HISTORY_SQL},
seen as (
  select icao, registration, type from pings
  where length(concat(icao, registration, type)) > 0 group by all),
known as (
  select icao, nullif(owner, '') as owner, nullif(manufacturer, '') as manufacturer,
         nullif(model, '') as model
  from history where is_current group by all)
select icao, registration, type, owner, manufacturer, model from seen left join known using (icao)"""


@query(ENRICHED_SQL)
def list_enriched(spark, sf_dir):
    return fleet.enriched_aircraft(views.pings(spark, sf_dir), views.registry_history(spark, sf_dir))


@query(
    ENRICHED_SQL
    + " order by icao, registration nulls first, type, owner, manufacturer, model limit 50 offset 50"
)
def list_enriched_page(spark, sf_dir):
    return fleet.list_enriched(
        views.pings(spark, sf_dir), views.registry_history(spark, sf_dir), 50, 1
    )


@query(
    f"""with {PINGS_SQL}
select icao, registration, type, emergency, source_date, count(*) as pings from pings
where icao <> '' and registration <> '' and type <> ''
group by icao, registration, type, emergency, source_date"""
)
def pings_identified(spark, sf_dir):
    found = filters.all_filled(views.pings(spark, sf_dir))
    return found.groupBy("icao", "registration", "type", "emergency", "source_date").agg(
        F.count("*").alias("pings")
    )


# --- snapshots and their typing --------------------------------------------------


def _documents(spark, sf_dir):
    return snapshots.parse_documents(views.snapshot_texts(spark, sf_dir), "text")


def _flat(spark, sf_dir, profile):
    flat = snapshots.flatten(_documents(spark, sf_dir), keep=("file_path",))
    return normalize.normalize(flat, profile)


FOUND = f"""icao, registration, type, lat, cast(null as double) as lon, altitude as alt_baro,
       {iso_sql('"time"')} as "timestamp", gs as ground_speed, emergency"""


@query(f"with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL} select {FOUND} from snapshot_rows")
def flatten_snapshots(spark, sf_dir):
    flat = snapshots.flatten(_documents(spark, sf_dir), keep=())
    numbers_of = {c: F.col(c).try_cast("double") for c in ("lat", "lon", "ground_speed")}
    return iso(flat.withColumns(numbers_of).withColumn("alt_baro", _token_text("alt_baro")), "timestamp")


def _token_text(column):
    return F.trim(F.col(column).cast("string"), F.lit('"'))


@query(f"with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL} select {FOUND} from snapshot_rows")
def normalize_raw(spark, sf_dir):
    raw = _flat(spark, sf_dir, "raw").select(*PING_COLUMNS)
    return raw.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon", "ground_speed")})


@query(
    f"""with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL}
select icao, registration, type, emergency, lat, cast(null as double) as lon,
       cast(trunc(try_cast(altitude as double)) as int) as alt_baro,
       gs as ground_speed, {iso_sql('"time"')} as "timestamp"
from snapshot_rows"""
)
def normalize_int(spark, sf_dir):
    return iso(_flat(spark, sf_dir, "int_or_null").select(*PING_COLUMNS), "timestamp")


ZERO_FILLED = f"""icao, registration, type, emergency, coalesce(lat, 0) as lat, cast(0 as double) as lon,
       coalesce(cast(trunc(try_cast(altitude as double)) as bigint), 0) as alt_baro,
       coalesce(gs, 0) as ground_speed, {iso_sql('"time"')} as "timestamp\""""


@query(f"with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL} select {ZERO_FILLED} from snapshot_rows")
def normalize_zero(spark, sf_dir):
    return iso(_flat(spark, sf_dir, "zero_fill").select(*PING_COLUMNS), "timestamp")


@query(
    f"""with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL}
select cut, case when cut then substr(id, 1, 6) else id end as icao,
       coalesce(registration, '') as registration,
       coalesce(type, '') as type, coalesce(emergency, '') as emergency, count(*) as pings,
       max(coalesce(cast(trunc(try_cast(altitude as double)) as int), 0)) as top_altitude
from (select *, case when icao like '~%' then concat(icao, '-tis-b') else icao end as id from snapshot_rows),
     (values (true), (false)) c(cut)
group by 1, 2, 3, 4, 5"""
)
def gold_conventions(spark, sf_dir):
    """Ids of more than six characters, as they are and cut."""
    silver = _flat(spark, sf_dir, "zero_fill")
    longer = F.when(F.col("icao").startswith("~"), F.concat("icao", F.lit("-tis-b"))).otherwise(F.col("icao"))
    silver = silver.withColumn("icao", longer)
    both = [
        normalize.gold_pings(silver, truncate_icao=cut).withColumn("cut", F.lit(cut)) for cut in (True, False)
    ]
    return both[0].unionByName(both[1]).groupBy("cut", "icao", "registration", "type", "emergency").agg(
        F.count("*").alias("pings"), F.max("alt_baro").alias("top_altitude")
    )


@query(
    """select concat('events/', event_id, '.json') as file_path, value <= 250 as ok,
       case when value <= 250 then cast(2 as bigint) else 0 end as pings from events"""
)
def file_outcomes(spark, sf_dir):
    return quality.file_outcomes(_documents(spark, sf_dir))


@query(
    """select count(*) filter (value <= 250) as files_ok, count(*) filter (value > 250) as files_failed,
       count(*) as files_total, 2 * count(*) filter (value <= 250) as pings from events"""
)
def file_outcome_totals(spark, sf_dir):
    return quality.outcome_totals(quality.file_outcomes(_documents(spark, sf_dir)))


@query(f"with {READABLE_SQL}, {SNAPSHOT_ROWS_SQL} select file_path, {ZERO_FILLED} from snapshot_rows")
def gzip_fallback(spark, sf_dir):
    """Landed bytes that may be JSON or gzip, down to typed pings."""
    payloads = views.snapshot_payloads(spark, sf_dir)
    texts = payloads.select("file_path", snapshots.payload_text("content").alias("text"))
    flat = snapshots.flatten(snapshots.parse_documents(texts, "text"), keep=("file_path",))
    typed = normalize.normalize(flat, "zero_fill")
    return iso(typed.select("file_path", *PING_COLUMNS), "timestamp")


@query(
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
       case when event_type = 'error' then null else event_type end as kind from events"""
)
def lenient_json(spark, sf_dir):
    damaged = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_type
             WHEN 'click' THEN replace(props, '}', ',"kind":"click",}')
             WHEN 'view' THEN concat('{k: ', get_json_object(props, '$.k'), ', kind : "view"}')
             WHEN 'error' THEN props
             ELSE concat('{"k": ', get_json_object(props, '$.k'), ' ,kind:"', event_type, '", list: [1, ], }')
           END AS text""",
    )
    parsed = damaged.select("event_id", snapshots.lenient_json("text").alias("json"))
    return parsed.select(
        "event_id",
        F.try_variant_get("json", "$.k", "bigint").alias("k"),
        F.try_variant_get("json", "$.kind", "string").alias("kind"),
    )


@query(
    """select p_partkey, p_name as aircraft_type, p_brand as name,
       case when p_size > 40 then cast(0 as double) when p_size > 30 then null
            else cast(p_size as double) end as galph,
       p_type as category, '' as source from part
union all
select p_partkey, concat(p_name, ' spare'), '', cast(0 as double), '', 'catalog' from part"""
)
def dynamic_key_object(spark, sf_dir):
    objects = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """concat('{"', p_name, '":{"name":"', p_brand, '","category":"', p_type, '"',
             CASE WHEN p_size > 40 THEN '' WHEN p_size > 35 THEN ',"galph":null'
                  WHEN p_size > 30 THEN ',"galph":"n/a"' WHEN p_size > 20 THEN concat(',"galph":"', p_size, '"')
                  ELSE concat(',"galph":', p_size) END,
             '},"', p_name, ' spare":{"source":"catalog"}}') AS text""",
    )
    return fuel.fuel_rates(objects, "text", keep=("p_partkey",))


# --- text, numbers, days -----------------------------------------------------------

WS = "concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(32), chr(160), chr(8195), chr(12288))"


@query(f"select doc_id, trim(text, {WS}) as text from documents")
def trim_text(spark, sf_dir):
    padded = F.concat(F.lit("\t 　"), "text", F.lit("\xa0\r\n "))
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_text(padded).alias("text"))


@query(
    """select doc_id, trim(replace(replace(replace(replace(text, '\\t', chr(9)), '\\n', chr(10)),
       '\\r', chr(13)), '\\\\', '\\'), concat('"', '''', ' ', chr(9), chr(10), chr(13))) as text
from (select doc_id, concat(replace(text, ' la ', '\\tla\\\\'), '\\n') as text from documents)"""
)
def text_canonical(spark, sf_dir):
    noisy = F.concat(
        F.lit(" \"' "), F.replace("text", F.lit(" la "), F.lit("\\tla\\\\")), F.lit("\\n'\" ")
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.canonical_text(noisy).alias("text"))


@query("select p_partkey, substr(p_name, 1, 6) as icao from part")
def truncate_id(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.truncate_icao("p_name").alias("icao"))


@query(
    """select doc_id, replace(replace(replace(concat('''', text, ';--', lang, '-;-'), '''', ''), ';', ''),
       '--', '') as id from documents"""
)
def clean_id(spark, sf_dir):
    dirty = F.concat(F.lit("'"), "text", F.lit(";--"), "lang", F.lit("-;-"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_id(dirty).alias("id"))


@query(
    f"""with {HISTORY_SQL} select icao, version, nullif(owner, '') as owner, manufacturer, year from history"""
)
def empty_to_null(spark, sf_dir):
    rows = views.registry_history(spark, sf_dir).select("icao", "version", "owner", "manufacturer", "year")
    return text.empty_to_null(rows)


@query(
    f"""with {PINGS_SQL} select icao, coalesce(registration, '') as registration, type, source_date,
       count(*) as pings from pings group by all"""
)
def null_to_default(spark, sf_dir):
    rows = text.null_to_default(views.pings(spark, sf_dir), {"registration": "", "type": "", "lat": 0.0})
    return rows.groupBy("icao", "registration", "type", "source_date").agg(F.count("*").alias("pings"))


@query(
    """select p_partkey, case when p_size % 10 = 0 then null else cast(1950 + p_size as bigint) end as year,
       p_type = 'ECONOMY' as mil, p_size > 25 as faa_pia from part"""
)
def year_and_flags(spark, sf_dir):
    written = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size % 20 = 0 THEN 'n/a' WHEN p_size % 10 = 0 THEN '' ELSE concat(' ', 1950 + p_size) END AS year",
        "CASE WHEN p_type = 'ECONOMY' THEN 'true' WHEN p_size > 25 THEN 'perhaps' END AS mil",
        "if(p_size > 25, '1', 'false') AS faa_pia",
    )
    return written.select(
        "p_partkey",
        numbers.year_or_null("year").alias("year"),
        numbers.flag_or_false("mil").alias("mil"),
        numbers.flag_or_false("faa_pia").alias("faa_pia"),
    )


@query(
    """select doc_id, toxic, case when quality = 1 then toxic + 0.5 else 0 end as number,
       case when quality = 1 then null else 0 - toxic end as whole
from (select doc_id, cast(toxic as double) as toxic, quality from labels)"""
)
def number_or_zero(spark, sf_dir):
    written = table(spark, sf_dir, "labels").selectExpr(
        "doc_id",
        "cast(toxic AS double) AS toxic",
        "if(quality = 1, concat(' ', toxic + 0.5, 'e0 '), concat(toxic, 'd')) AS number",
        "if(quality = 1, 'ground', concat('-', toxic, '.9')) AS whole",
    )
    return written.select(
        "doc_id",
        "toxic",
        numbers.number_or_zero("number").alias("number"),
        numbers.int_or_null("whole").cast("double").alias("whole"),
    )


@query(
    """select o_orderkey, day, case when try_cast(day as date) is null then null
       else replace(day, '-', '') end as source_date
from (select o_orderkey, concat(strftime(o_orderdate, '%Y-%m-'),
        lpad(cast(day(o_orderdate) + 1 as varchar), 2, '0')) as day from orders)"""
)
def day_check(spark, sf_dir):
    shifted = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat(date_format(o_orderdate, 'yyyy-MM-'), lpad(day(o_orderdate) + 1, 2, '0')) AS day",
    )
    return shifted.select("o_orderkey", "day", times.day_to_source_date("day").alias("source_date"))


@query(
    """select o_orderkey, concat(strftime(case when o_orderstatus = 'P'
         then timestamp '1677-09-21 00:12:43.145224' else o_orderdate end, '%Y-%m-%dT%H:%M:%S'),
       case when o_orderstatus = 'P' then '.145224' else '' end) as moment from orders"""
)
def time_or_floor(spark, sf_dir):
    written = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderstatus = 'P', 'pending', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")) AS written",
    )
    return iso(written.select("o_orderkey", times.timestamp_or_floor("written").alias("moment")), "moment")


# --- listings ------------------------------------------------------------------------

LINKS_SQL = """select page_id,
       unnest(list_sort(list_transform(regexp_extract_all(html, 'href="(.*?)"', 1), lambda x: concat(x, '.gz')))) as link
from pages"""


@query(LINKS_SQL)
def index_links(spark, sf_dir):
    """Every link, each made one to a compressed file."""
    zipped = F.regexp_replace("html", r'href="([^\n]*?)"', 'href="$1.gz"')
    return listings.index_links(table(spark, sf_dir, "pages").withColumn("html", zipped), keep=("page_id",))


@query(
    """select page_id, unnest(list_sort(regexp_extract_all(html, 'href="(.*?)"', 1))[1:3]) as link from pages"""
)
def index_links_first(spark, sf_dir):
    return listings.index_links(table(spark, sf_dir, "pages"), suffix="", limit=3, keep=("page_id",))


@query(
    """select strftime(day, '%Y%m%d') as source_date,
       strftime(day + to_seconds(slot * 5), '%H%M%SZ.json.gz') as file_name
from (select distinct date_trunc('day', ts) as day from events), range(17280) r(slot)"""
)
def snapshot_grid(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return listings.snapshot_names(days)


@query(
    """select strftime(month, '%Y-%m-%d') as run_date, strftime(month, '%Y%m%d') as source_date
from (select unnest(range(date_trunc('month', min(o_orderdate)),
        date_trunc('month', max(o_orderdate)) + interval 1 month, interval 1 month)) as month from orders)"""
)
def run_dates(spark, sf_dir):
    return listings.run_dates_of(table(spark, sf_dir, "orders"), "o_orderdate")


# --- history ---------------------------------------------------------------------------

DEDUP_SQL = """load as (
  select * from (select *, row_number() over (partition by icao order by
      reg nulls first, icaotype nulls first, year nulls first, manufacturer nulls first,
      model nulls first, owner nulls first, faa_pia, faa_ladd, short_type nulls first, mil) as rn,
    count(*) over (partition by icao) as copies from incoming) where rn = 1)"""


def _canon(side: str, c: str) -> str:
    return (
        f"""trim(replace(replace(replace(replace(trim({side}.{c}), '\\t', chr(9)), '\\n', chr(10)),"""
        f""" '\\r', chr(13)), '\\\\', '\\'), concat('"', '''', ' ', chr(9), chr(10), chr(13)))"""
    )


TEXTS = ["reg", "icaotype", "manufacturer", "model", "owner", "short_type"]
OTHERS = ["year", "faa_pia", "faa_ladd", "mil"]
DIFFERS = " or ".join(
    [f"{_canon('n', c)} is distinct from {_canon('c', c)}" for c in TEXTS]
    + [f"n.{c} is distinct from c.{c}" for c in OTHERS]
)
CHANGES_SQL = f"""changes as (
  select n.*, case when c.icao is null then 'new' when {DIFFERS} then 'changed' else 'same' end as change
  from load n left join (select * from history where is_current) c on n.icao = c.icao)"""
FIELDS = ", ".join(history.FIELDS)
AT = f"timestamp '{LOADED_AT}'"
MERGED_SQL = f"""merged as (
  select {FIELDS}, valid_from,
         case when is_current and hit then {AT} else valid_to end as valid_to,
         is_current and not hit as is_current, version, source_date
  from (select h.*, exists (select 1 from changes g where g.icao = h.icao and g.change <> 'same') as hit
        from history h)
  union all
  select {FIELDS}, {AT}, null, true, (select max(version) + 1 from history), '20240201'
  from changes where change <> 'same')"""
SCD_SQL = f"{HISTORY_SQL}, {INCOMING_SQL}, {DEDUP_SQL}, {CHANGES_SQL}, {MERGED_SQL}"
SHOWN = f"{FIELDS}, {iso_sql('valid_from')} as valid_from, {iso_sql('valid_to')} as valid_to, is_current, version, source_date"


def _merged(spark, sf_dir):
    return history.merge(
        views.registry_history(spark, sf_dir),
        registry.clean_registry(views.registry_load(spark, sf_dir)),
        loaded_at=datetime.fromisoformat(LOADED_AT),
        source_date="20240201",
    )


@query(f"with {HISTORY_SQL}, {INCOMING_SQL}, {DEDUP_SQL} select {FIELDS}, copies from load")
def incoming_dedup(spark, sf_dir):
    return history.one_row_per_key(views.registry_load(spark, sf_dir))


@query(f"with {SCD_SQL} select icao, reg, owner, change from changes")
def change_detection(spark, sf_dir):
    load = history.one_row_per_key(views.registry_load(spark, sf_dir)).drop("copies")
    changes = history.classify(load, views.registry_history(spark, sf_dir))
    return changes.select("icao", "reg", "owner", "change")


@query(
    f"""with {HISTORY_SQL}
select icao, version, is_current and owner <> '' as is_current,
       {iso_sql(f"case when is_current and owner = '' then {AT} else valid_to end")} as valid_to
from history"""
)
def close_rows(spark, sf_dir):
    rows = views.registry_history(spark, sf_dir)
    ownerless = filters.current_only(rows).where("owner = ''")
    closed = history.close_rows(rows, ownerless, datetime.fromisoformat(LOADED_AT))
    return iso(closed.select("icao", "version", "is_current", "valid_to"), "valid_to")


@query(f"with {HISTORY_SQL} select icao, owner, version from history where icao in (select icao from history where owner = 'FORMER OWNER')")
def rows_of_keys(spark, sf_dir):
    rows = views.registry_history(spark, sf_dir)
    return filters.with_keys(rows, rows.where("owner = 'FORMER OWNER'")).select("icao", "owner", "version")


@query(f"with {SCD_SQL} select {SHOWN} from merged")
def scd2_merge(spark, sf_dir):
    return iso(_merged(spark, sf_dir), "valid_from", "valid_to")


@query(f"with {SCD_SQL} select {FIELDS}, version from merged where is_current")
def scd2_current(spark, sf_dir):
    return filters.current_only(_merged(spark, sf_dir)).select(*history.FIELDS, "version")


@query(f"with {HISTORY_SQL} select {SHOWN} from history")
def scd2_noop(spark, sf_dir):
    rows = views.registry_history(spark, sf_dir)
    same = history.merge(
        rows,
        filters.current_only(rows).select(*history.FIELDS),
        loaded_at=datetime.fromisoformat(LOADED_AT),
        source_date="20240201",
    )
    return iso(same, "valid_from", "valid_to")


@query(f"with {SCD_SQL} select {SHOWN} from merged")
def registry_history_job(spark, sf_dir):
    """Two loads through the stored history: silver folder, gold folders, log."""
    root = scratch_path(spark, "registry")
    load = registry.clean_registry(views.registry_load(spark, sf_dir))
    first = views.registry_history(spark, sf_dir)
    silver = f"{root}/silver"
    for number, rows, day, at in (
        (1, first.where("NOT is_current"), "2023-10-01", views.EARLIEST),
        (2, first.where("is_current"), "2023-11-01", views.EARLIER),
        (3, load, "2024-02-01", LOADED_AT),
    ):
        records = normalize.conform(rows, registry.REGISTRY)
        path = sinks.write_versioned(records, silver, times.day_argument(day), number)
        registry_plan.to_gold(spark, path, f"{root}/gold", day, datetime.fromisoformat(f"{at}+00:00"))
    stored = registry_plan.read_history(spark, f"{root}/gold").select(*history.HISTORY_FIELDS)
    return iso(stored, "valid_from", "valid_to")


# --- files and versions ------------------------------------------------------------------

FILES_SQL = """files as (
  select concat('bronze/', source, '/pages_v', doc_id, '.txt') as path, source as _in_date,
         cast(doc_id as int) as version, encode(text) as content from documents)"""


def _files(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("bronze/"), "source", F.lit("/pages_v"), "doc_id", F.lit(".txt")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("source").alias("_in_date"),
        "lang",
    )


def _listing(spark, sf_dir):
    return _files(spark, sf_dir).select("path", "_in_date", files.name_version("path").alias("version"))


@query(
    f"""with {FILES_SQL} select path, _in_date, octet_length(content) as size, version,
       sha256(content) as file_hash, 'landing' as source from files"""
)
def file_manifest(spark, sf_dir):
    return versions.manifest(_files(spark, sf_dir), source="landing").drop("_loaded_time")


@query("select doc_id, sha256(text) as file_hash from documents")
def file_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", files.content_hash("text").alias("file_hash"))


@query(
    f"""with {FILES_SQL} select _in_date, max(version) as version,
       arg_max(path, version) as path from files group by _in_date"""
)
def version_latest(spark, sf_dir):
    return versions.latest_version(_listing(spark, sf_dir))


@query(
    f"""with {FILES_SQL} select _in_date, max(version) + 1 as next_version from files group by _in_date
union all select distinct concat('new-', lang), 1 from documents"""
)
def version_next(spark, sf_dir):
    found = _files(spark, sf_dir)
    wanted = found.select("_in_date").union(found.select(F.concat(F.lit("new-"), "lang")))
    return versions.next_version(_listing(spark, sf_dir), wanted)


@query(
    f"""with {FILES_SQL} select path, _in_date, version from (
  select *, row_number() over (partition by _in_date order by version desc) as rn from files) where rn > 3"""
)
def version_retain(spark, sf_dir):
    return versions.superseded_versions(_listing(spark, sf_dir))


@query(
    f"""with {FILES_SQL} select path, position('/src1' in path) = 0 as found,
       position('/src1' in path) = 0 and position('/src2' in path) = 0 as intact from files"""
)
def manifest_verify(spark, sf_dir):
    stored = versions.manifest(_files(spark, sf_dir).where("NOT contains(path, '/src1')"))
    expected = versions.manifest(_files(spark, sf_dir)).select(
        "path",
        F.when(F.col("path").contains("/src2"), "damaged").otherwise(F.col("file_hash")).alias("file_hash"),
    )
    return versions.verify(stored, expected)


@query(f"with {FILES_SQL} select path, octet_length(content) as length, sha256(content) as sha256, _in_date from files")
def bronze_archive(spark, sf_dir):
    root = scratch_path(spark, "bronze-archive")
    sinks.archive_bytes(_files(spark, sf_dir), root)
    kept = spark.read.parquet(root)
    return kept.where(files.content_hash("content") == F.col("sha256")).select(
        "path", "length", "sha256", "_in_date"
    )


# --- load statistics ---------------------------------------------------------------------


@query(
    f"""with {PINGS_SQL} select count(*) as total_records, count(distinct icao) as unique_aircraft,
       count(distinct source_date) as unique_dates from pings"""
)
def load_stats_pings(spark, sf_dir):
    return quality.ping_load_stats(views.pings(spark, sf_dir))


@query(
    f"""with {SCD_SQL} select count(*) as total_records, count(*) filter (is_current) as current_records,
       count(distinct version) as versions, count(distinct icao) as unique_aircraft,
       count(distinct source_date) as unique_dates, max(version) as latest_version from merged"""
)
def load_stats_registry(spark, sf_dir):
    return quality.registry_load_stats(_merged(spark, sf_dir))


# --- sinks: written, read back -------------------------------------------------------------

PING_ROWS = f"""icao, registration, type, lat, lon, alt_baro, {iso_sql('"timestamp"')} as "timestamp",
       ground_speed, emergency"""


def _silver(spark, sf_dir, label, **options):
    """Events as silver pings in a fresh folder; the folder."""
    root = f"{scratch_path(spark, label)}/silver"
    rows = normalize.normalize(views.pings(spark, sf_dir), "zero_fill")
    sinks.write_layer(rows.withColumnRenamed("source_date", "_in_date"), root, **options)
    return root


@query(
    f"""with {PINGS_SQL} select icao, registration, type, lat, lon, cast(alt_baro as bigint) as alt_baro,
       {iso_sql('"timestamp"')} as "timestamp", ground_speed, emergency, source_date as _in_date from pings"""
)
def silver_roundtrip(spark, sf_dir):
    return iso(tables.read_layer(spark, _silver(spark, sf_dir, "silver"), PINGS_SILVER), "timestamp")


@query(
    f"""with {PINGS_SQL} select source_date as _in_date, count(*) as pings from pings
where source_date in ('20240101', '20240105') group by source_date"""
)
def silver_day_scan(spark, sf_dir):
    root = _silver(spark, sf_dir, "silver-days")
    days = tables.read_layer(spark, root, PINGS_SILVER, ["20240101", "20240105", "19990101"])
    return days.groupBy("_in_date").agg(F.count("*").alias("pings"))


# Texts that text formats stumble over, by the user's number.
AWKWARD = """case user_id % 8 when 0 then '' when 1 then null when 2 then concat('a', chr(9), 'b')
    when 3 then concat('l1', chr(10), 'l2') when 4 then concat(chr(92), 'N')
    when 5 then concat('back', chr(92), 'slash ', chr(92), 't') when 6 then 'say "hi", {x}' else event_type end"""


def _awkward(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{AWKWARD} AS text", "value", "cast(ts AS timestamp) AS timestamp", "user_id"
    )


@query(
    f"""select cast(event_id as varchar) as icao, coalesce({AWKWARD}, '') as registration,
       cast(value as varchar) as lat, cast(value as varchar) as lon, '' as alt_baro, '' as ground_speed,
       {iso_sql('ts')} as "timestamp", '' as type, '' as emergency from events"""
)
def csv_roundtrip(spark, sf_dir):
    """The nine columns come back as given; null as empty text."""
    path = scratch_path(spark, "csv")
    given = _awkward(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("icao"),
        F.col("text").alias("registration"),
        *[F.lit(None).cast("string").alias(c) for c in ("type", "alt_baro", "ground_speed", "emergency")],
        F.col("value").cast("string").alias("lat"),
        F.col("value").cast("string").alias("lon"),
        times.iso_timestamp("timestamp").alias("timestamp"),
    )
    sinks.write_prepared_csv(given, path)
    return tables.read_prepared_csv(spark, path)


@query(
    f"""select event_id, {AWKWARD} as text, value, user_id,
       {iso_sql('ts')} as "timestamp", 2 as n,
       concat_ws('|', coalesce({AWKWARD}, 'none'), cast(user_id as varchar)) as parts
from events"""
)
def tsv_roundtrip(spark, sf_dir):
    """Texts and arrays of texts come back as given."""
    path = scratch_path(spark, "tsv")
    given = _awkward(spark, sf_dir).withColumn("parts", F.array("text", F.col("user_id").cast("string")))
    sinks.write_tsv(given, path)
    back = tables.read_tsv(spark, path, given.schema)
    shown = F.array_join("parts", "|", "none")
    return iso(back.withColumn("n", F.size("parts")).withColumn("parts", shown), "timestamp")


@query(
    f"""with {PINGS_SQL}, last_day as (select max(source_date) as d from pings)
select {PING_ROWS.replace('type,', "case when source_date = d then upper(type) else type end as type,")},
       source_date from pings, last_day"""
)
def day_overwrite(spark, sf_dir):
    """All days, then the last day again with other rows: the rest must stay."""
    root = scratch_path(spark, "days")
    rows = views.pings(spark, sf_dir)
    sinks.write_layer(rows, root, partition="source_date")
    last = rows.agg(F.max("source_date")).first()[0]
    again = rows.where(F.col("source_date") == last).withColumn("type", F.upper("type"))
    sinks.write_layer(again, root, partition="source_date")
    return iso(tables.read_layer(spark, root, PINGS_TYPED, partition="source_date"), "timestamp")


@query(
    f"""with {PINGS_SQL} select icao, type, source_date, count(*) as pings from
(select * from pings union all select * from pings) group by icao, type, source_date"""
)
def gold_append(spark, sf_dir):
    root = scratch_path(spark, "append")
    rows = views.pings(spark, sf_dir)
    sinks.write_layer(rows, root, partition="source_date", mode="append")
    sinks.write_layer(rows, root, partition="source_date", mode="append")
    stored = tables.read_layer(spark, root, PINGS_TYPED, partition="source_date")
    return stored.groupBy("icao", "type", "source_date").agg(F.count("*").alias("pings"))


@query(f"with {PINGS_SQL} select {PING_ROWS}, 4 as version from pings")
def versioned_write(spark, sf_dir):
    root = scratch_path(spark, "versioned")
    rows = views.pings(spark, sf_dir).select(*PING_COLUMNS)
    for version, written in ((3, rows.where("alt_baro < 5000")), (4, rows)):
        sinks.write_versioned(written, root, "20240101", version)
    stored = spark.read.parquet(f"{root}/_in_date=20240101")
    newest = stored.agg(F.max("version").alias("version"))
    return iso(stored.where(F.col("version") == newest.scalar()).select(*PING_COLUMNS, "version"), "timestamp")


@query(
    f"""with {PINGS_SQL} select icao, coalesce(registration, '') as registration, type, lat, lon, alt_baro,
       {iso_sql('"timestamp"')} as "timestamp", ground_speed, emergency, source_date,
       'bronze,silver,gold' as systems, true as located from pings"""
)
def pings_job(spark, sf_dir):
    """Silver folder to gold table by the job, with lineage."""
    silver = _silver(spark, sf_dir, "pings-job")
    gold_root = silver.removesuffix("silver") + "gold"
    pings_plan.to_gold(spark, silver, gold_root)
    gold = pings_plan.read_gold(spark, gold_root)
    located = F.col("_file_location").contains(F.concat(F.lit("_in_date="), "source_date"))
    return iso(
        gold.select(
            *PING_COLUMNS,
            "source_date",
            F.array_join("_systems_passed", ",").alias("systems"),
            (located & F.col("_loaded_time").isNotNull()).alias("located"),
        ),
        "timestamp",
    )


@query(
    f"""with {PINGS_SQL} select icao, type, source_date, 'silver/a.parquet' as _file_location,
       'bronze,silver,gold' as systems, count(*) as pings from pings group by all"""
)
def lineage_columns(spark, sf_dir):
    gold = add_lineage(
        views.pings(spark, sf_dir), file_location="silver/a.parquet", source_date=F.col("source_date")
    ).select(*PINGS_GOLD.fieldNames())
    return (
        gold.withColumn("systems", F.array_join("_systems_passed", ","))
        .groupBy("icao", "type", "source_date", "_file_location", "systems")
        .agg(F.count("*").alias("pings"))
    )


@query(
    f"""with {INCOMING_SQL} select icao, reg, icaotype, cast(year as bigint) as year, manufacturer,
       coalesce(model, '') as model, owner, faa_pia, false as faa_ladd, short_type, mil
from incoming where owner <> ''"""
)
def jsonl_registry(spark, sf_dir):
    """Registry as compressed JSON Lines: damaged lines where owner is empty."""
    path = _registry_lines(spark, sf_dir)
    return registry.registry_records(registry.scan_registry_lines(spark, path))


@query(
    f"""with {INCOMING_SQL} select count(*) filter (owner <> '') as good_lines,
       count(*) filter (owner = '') as bad_lines, count(*) filter (owner <> '') as keyed_lines
from incoming"""
)
def line_outcomes(spark, sf_dir):
    lines = registry.scan_registry_lines(spark, _registry_lines(spark, sf_dir))
    totals = ("good_lines", "bad_lines", "keyed_lines")
    return quality.line_outcomes(lines).agg(*[F.sum(c).alias(c) for c in totals])


def _registry_lines(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    rows = views.registry_load(spark, sf_dir).withColumnRenamed("owner", "ownop").drop("faa_ladd")
    line = F.to_json(F.struct(*rows.columns))
    cut = F.when(F.col("ownop") == "", F.expr("substr(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    rows.withColumn("line", line).select(cut.alias("value")).write.option("compression", "gzip").text(path)
    return path


@query("select count(*) as rows from events")
def parquet_row_count(spark, sf_dir):
    views.configure(spark)
    return tables.count_rows(spark, f"{sf_dir}/events.parquet")



# --- jobs from landed files ----------------------------------------------------------------

# Documents hold the events of a day whose ids lie in the same thousand.
LANDED_SQL = """landed as (
  select e.*, strftime(ts, '%Y%m%d') as day, event_id // 1000 as number, event_id // 1000 % 8 as slot,
         min(ts) over (partition by strftime(ts, '%Y%m%d'), event_id // 1000) as now from events e)"""


def _landed(spark, sf_dir, label):
    """Snapshot files of a day's events, at most a thousand each: plain, gzip, cut off
    (slot 7) and with text after the document (slot 6)."""
    root = f"{scratch_path(spark, label)}/bronze"
    entry = F.struct(
        F.expr("lpad(lower(hex(user_id)), 6, '0')").alias("hex"),
        F.expr("if(user_id % 7 = 0, null, concat('N', user_id))").alias("r"),
        F.col("event_type").alias("t"),
        F.col("value").alias("lat"),
        (F.col("value") / 2).alias("lon"),
        F.expr("cast(get_json_object(props, '$.k') AS int) * 100").alias("alt_baro"),
        F.col("value").alias("gs"),
        F.expr("if(event_type = 'error', 'general', 'none')").alias("emergency"),
    )
    docs = (
        table(spark, sf_dir, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy(F.date_format("ts", "yyyyMMdd").alias("_in_date"), F.expr("event_id div 1000").alias("number"))
        .agg(F.min("ts").alias("at"), F.collect_list(entry).alias("aircraft"))
        .withColumn("text", F.to_json(F.struct((F.unix_micros("at") / 1e6).alias("now"), "aircraft")))
        .withColumn("slot", F.col("number") % 8)
    )
    text = (
        F.when(F.col("slot") == 7, F.expr("substr(text, 1, length(text) - 3)"))
        .when(F.col("slot") == 6, F.concat("text", F.lit(" more")))
        .otherwise(F.col("text"))
    )
    files_df = docs.select(text.alias("value"), "_in_date", "slot")
    for packed, compression in ((0, "none"), (1, "gzip")):
        files_df.where(F.col("slot") % 2 == packed).drop("slot").write.mode("append").option(
            "compression", compression
        ).option("maxRecordsPerFile", 1).partitionBy("_in_date").text(root)
    return root


LANDED_ROWS = f"""lpad(lower(hex(user_id)), 6, '0') as icao,
       case when user_id % 7 = 0 then '' else concat('N', user_id) end as registration, event_type as type,
       value as lat, value / 2 as lon, cast(json_extract_string(props, '$.k') as int) * 100 as alt_baro,
       {iso_sql('now')} as "timestamp", value as ground_speed,
       case when event_type = 'error' then 'general' else 'none' end as emergency"""


@query(
    f"""with {LANDED_SQL} select {LANDED_ROWS}, day as source_date, 'bronze,silver,gold' as systems
from landed where slot < 6"""
)
def snapshot_job(spark, sf_dir):
    """Files to gold, twice; the second run replaces the days with the same."""
    bronze = _landed(spark, sf_dir, "snapshot-job")
    silver, gold = bronze.replace("bronze", "silver"), bronze.replace("bronze", "gold")
    for any_payload in (True, False):
        pings_plan.run_pings(spark, bronze, silver, gold, any_payload=any_payload)
    stored = pings_plan.read_gold(spark, gold)
    return iso(
        stored.select(*PING_COLUMNS, "source_date", F.array_join("_systems_passed", ",").alias("systems")),
        "timestamp",
    )


@query(
    f"""with {LANDED_SQL}, docs as (select day, number, max(slot) as slot from landed group by day, number)
select count(*) filter (slot < 6) as files_ok, count(*) filter (slot >= 6) as files_failed,
       (select count(*) from landed where slot < 6) as total_records,
       (select count(distinct user_id) from landed where slot < 6) as unique_aircraft,
       (select count(distinct day) from landed where slot < 6) as unique_dates from docs"""
)
def snapshot_job_report(spark, sf_dir):
    bronze = _landed(spark, sf_dir, "snapshot-report")
    report = pings_plan.run_pings(
        spark, bronze, bronze.replace("bronze", "silver"), bronze.replace("bronze", "gold")
    )
    gold = report.gold
    row = (report.files_ok, report.files_failed, gold.total_records, gold.unique_aircraft, gold.unique_dates)
    return spark.createDataFrame(
        [row],
        struct("files_ok bigint, files_failed bigint, total_records bigint, unique_aircraft bigint, unique_dates bigint"),
    )


@query(f"with {LANDED_SQL} select {LANDED_ROWS}, day as _in_date from landed where slot < 6")
def bronze_to_silver_archive(spark, sf_dir):
    """Files kept as bytes in Parquet, and documents read from there."""
    bronze = _landed(spark, sf_dir, "archive-job")
    archive = bronze.replace("bronze", "archive")
    sinks.archive_bytes(versions.scan_files(spark, bronze), archive)
    flat = snapshots.flatten(snapshots.scan_archive(spark, archive), keep=("_in_date",))
    typed = normalize.normalize(flat, "zero_fill")
    filled = text.null_to_default(typed, {"registration": ""})
    return iso(filled.withColumn("alt_baro", F.col("alt_baro").cast("int")), "timestamp")


@query(f"with {SCD_SQL} select {SHOWN} from merged")
def registry_job(spark, sf_dir):
    """Three deliveries of compressed JSON Lines through landing, silver and
    history, the last one twice: a load without changes adds nothing."""
    root = scratch_path(spark, "registry-job")
    first = views.registry_history(spark, sf_dir)
    deliveries = (
        (first.where("NOT is_current"), "2023-10-01", views.EARLIEST),
        (first.where("is_current"), "2023-11-01", views.EARLIER),
        (views.registry_load(spark, sf_dir), "2024-02-01", LOADED_AT),
        (views.registry_load(spark, sf_dir), "2024-02-01", "2024-02-02 06:00:00"),
    )
    for number, (rows, day, at) in enumerate(deliveries):
        fields = [F.col(c).alias("ownop" if c == "owner" else c) for c in history.FIELDS]
        lines = rows.select(F.to_json(F.struct(*fields)).alias("value"))
        lines.write.option("compression", "gzip").text(f"{root}/in/{number}")
        registry_plan.land(spark, f"{root}/in/{number}", f"{root}/bronze", day)
        path = registry_plan.landed_to_silver(spark, f"{root}/bronze", f"{root}/silver", day)
        registry_plan.to_gold(spark, path, f"{root}/gold", day, datetime.fromisoformat(f"{at}+00:00"))
    stored = registry_plan.read_history(spark, f"{root}/gold").select(*history.HISTORY_FIELDS)
    return iso(stored, "valid_from", "valid_to")


@query(
    """select p_name as aircraft_type, max(p_brand) as name, max(cast(p_size as double)) as galph
from part group by p_name"""
)
def fuel_job(spark, sf_dir):
    """A landed JSON object through silver to gold; a repeated key keeps its last."""
    root = scratch_path(spark, "fuel-job")
    part = table(spark, sf_dir, "part").groupBy("p_name").agg(
        F.max("p_brand").alias("name"), F.max("p_size").alias("galph")
    )
    part.select(
        F.concat(
            F.lit('{"'), "p_name", F.lit('":{"galph":0},"'), "p_name", F.lit('":'),
            F.to_json(F.struct("name", "galph")), F.lit("}"),
        ).alias("value")
    ).write.option("maxRecordsPerFile", 1).text(f"{root}/fuel")
    fuel_plan.run_fuel(spark, f"{root}/fuel", f"{root}/silver", f"{root}/gold")
    return fuel_plan.read_gold(spark, f"{root}/gold").select("aircraft_type", "name", "galph")


@query(f"with {PINGS_SQL} select icao, type, count(*) as pings from pings group by icao, type")
def table_refresh_twice(spark, sf_dir):
    """A table folder that held other rows holds only the new ones."""
    path = scratch_path(spark, "refresh")
    rows = views.pings(spark, sf_dir)
    sinks.write_refresh(rows.withColumn("type", F.upper("type")), path)
    sinks.write_refresh(rows, path)
    return spark.read.parquet(path).groupBy("icao", "type").agg(F.count("*").alias("pings"))


@query(
    f"""with {LANDED_SQL}, first_day as (select min(day) as d from landed)
select {LANDED_ROWS.replace("case when user_id % 7 = 0 then '' else", "case when user_id % 7 = 0 then null else")}
from landed, first_day where slot < 6 and day = d"""
)
def prepare_table(spark, sf_dir):
    """One raw day to the typed table, by either reader."""
    raw = _landed(spark, sf_dir, "prepare-table")
    day = table(spark, sf_dir, "events").agg(F.date_format(F.min("ts"), "yyyy-MM-dd")).first()[0]
    root = raw.replace("bronze", "table")
    prepared = prepare_plan.read_day(spark, raw, day, partition="_in_date")
    sinks.write_refresh(normalize.typed_table(prepared).select(*PING_COLUMNS), root)
    return iso(spark.read.parquet(root), "timestamp")


@query(
    f"""with {LANDED_SQL}, first_day as (select min(day) as d from landed)
select lpad(lower(hex(user_id)), 6, '0') as icao,
       case when user_id % 7 = 0 then '' else concat('N', user_id) end as registration, event_type as type,
       cast(value as varchar) as lat, cast(value / 2 as varchar) as lon,
       cast(cast(json_extract_string(props, '$.k') as int) * 100 as varchar) as alt_baro,
       {iso_sql('now')} as "timestamp", cast(value as varchar) as ground_speed,
       case when event_type = 'error' then 'general' else 'none' end as emergency
from landed, first_day where slot < 6 and day = d"""
)
def prepare_csv(spark, sf_dir):
    """One raw day to prepared CSV twice, the second run in place of the first."""
    raw = _landed(spark, sf_dir, "prepare-csv")
    day = table(spark, sf_dir, "events").agg(F.date_format(F.min("ts"), "yyyy-MM-dd")).first()[0]
    for _ in range(2):
        path = prepare_plan.prepare_csv(spark, raw, raw.replace("bronze", "csv"), day, partition="_in_date")
    return tables.read_prepared_csv(spark, path)


@query(
    f"""with {LANDED_SQL}
select day, slot < 6 as ok, count(distinct number) as files,
       cast(sum(case when slot < 6 then 1 else 0 end) as bigint) as pings
from landed group by day, slot < 6"""
)
def silver_file_outcomes(spark, sf_dir):
    """What silver keeps about its files, after two runs of the same days."""
    bronze = _landed(spark, sf_dir, "outcomes")
    silver = bronze.replace("bronze", "silver")
    for _ in range(2):
        pings_plan.to_silver(spark, bronze, silver)
    return (
        pings_plan.read_outcomes(spark, silver)
        .groupBy(F.col("_in_date").alias("day"), "ok")
        .agg(F.count("*").alias("files"), F.sum("pings").alias("pings"))
    )


@query("select cast(1 as bigint) as found from (select count(*) as n from customer) where n > 0")
def found_check(spark, sf_dir):
    """A known aircraft passes the check for being there."""
    known = filters.current_only(views.registry_history(spark, sf_dir))
    return filters.require_rows(known, "any aircraft").agg((F.count("*") > 0).cast("bigint").alias("found"))
