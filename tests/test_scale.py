"""Plans and layouts that must hold when data grows or one key dominates."""

from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from aerolake.functions.text import is_filled
from aerolake.operators import emissions, fleet, quality, versions
from aerolake.operators.normalize import normalize
from aerolake.plans import pings as pings_plan
from aerolake.schemas import PINGS_SILVER
from aerolake.sinks import refresh_table, write_layer
from aerolake.sources import fuel, listings, snapshots, tables
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_pings(spark):
    """One aircraft holds half of all pings, all on one day."""
    return spark.range(40_000).selectExpr(
        "if(id % 2 = 0, 'hot', lpad(hex(id % 997), 6, '0')) AS icao",
        "concat('N', id % 997) AS registration",
        "if(id % 3 = 0, 'GLF6', 'C172') AS type",
        "cast(id AS double) AS lat",
        "cast(id AS double) AS lon",
        "id AS alt_baro",
        "timestamp_seconds(1698796800 + id) AS timestamp",
        "cast(id % 400 AS double) AS ground_speed",
        "'none' AS emergency",
        "'20231101' AS _in_date",
    )


def test_hot_day_is_split_over_files(spark, hot_pings, tmp_path):
    path = str(tmp_path / "silver")
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        write_layer(hot_pings, path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = sorted((tmp_path / "silver" / "_in_date=20231101").glob("*.parquet"))
    assert len(files) > 3
    holders = Counter()
    for file in files:
        icao = pq.read_table(file, columns=["icao"])["icao"].to_pylist()
        assert icao == sorted(icao)
        holders.update(set(icao))
    assert holders["hot"] > 3
    assert sum(n == 1 for n in holders.values()) > 0.9 * len(holders)
    back = tables.read_layer(spark, path, PINGS_SILVER)
    assert rows(back.agg(F.count("*"), F.sum("alt_baro"))) == rows(
        hot_pings.agg(F.count("*"), F.sum("alt_baro"))
    )


def test_gold_load_does_not_shuffle(spark, hot_pings, tmp_path):
    silver = str(tmp_path / "silver")
    write_layer(hot_pings, silver)
    pings_plan.to_gold(spark, silver, str(tmp_path / "gold"))
    gold = pings_plan.read_gold(spark, str(tmp_path / "gold"))
    assert gold.count() == 40_000
    lookup = plan(gold.where("icao = 'hot' AND source_date = '20231101'").select("lat"))
    assert "PushedFilters: [IsNotNull(icao), EqualTo(icao,hot)]" in lookup
    assert "(source_date" in lookup.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<icao:string,lat:double>" in lookup


def test_filled_filter_reaches_the_scan(spark, hot_pings, tmp_path):
    path = str(tmp_path / "t")
    hot_pings.write.parquet(path)
    text = plan(spark.read.parquet(path).where(is_filled("icao")))
    assert "IsNotNull(icao), Not(EqualTo(icao,))" in text


def test_documents_are_parsed_once(spark):
    docs = snapshots.parse_documents(spark.createDataFrame([("{}",)], "t string"), "t")
    flat = normalize(snapshots.flatten(docs, keep=()), "zero_fill")
    assert plan(flat).count("from_json(") == 1
    assert plan(flat.where("icao = 'a'")).count("from_json(") == 1
    rates = fuel.fuel_rates(spark.createDataFrame([("{}",)], "t string"), "t")
    assert plan(rates).count("from_json(") == 1
    links = listings.index_links(spark.createDataFrame([("x",)], "html string"))
    assert plan(links).count("regexp_extract_all(") == 1


def test_payloads_are_inflated_once(spark, bronze):
    flat = snapshots.flatten(snapshots.scan_snapshot_bytes(spark, bronze))
    text = plan(normalize(flat, "zero_fill"))
    assert text.count("ArrowEvalPython") == 1 and text.count("from_json(") == 1


def test_no_task_takes_a_hot_key_whole(spark, hot_pings):
    """Aggregates combine before the shuffle; top-k is never a full sort."""
    days = hot_pings.withColumn("source_date", F.date_format("timestamp", "yyyyMMdd"))
    rates = spark.sql("SELECT * FROM VALUES ('GLF6', 503D), ('B738', 9D) AS f(aircraft_type, galph)")
    for df in (
        fleet.stats(days),
        fleet.last_wins(days),
        fleet.distinct_aircraft(days),
        emissions.co2(days, rates),
        quality.ping_load_stats(days),
    ):
        text = plan(df)
        assert "partial_" in text or text.count("HashAggregate(keys=[icao") >= 2
        assert "Window" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
    assert "TakeOrderedAndProject" in plan(fleet.list_aircraft(days, 10, 3))
    assert "TakeOrderedAndProject" in plan(fleet.positions(days, "hot", 10, 3))


def test_version_ranking_is_cut_before_the_shuffle(spark):
    listing = spark.range(1000).selectExpr(
        "concat('f_v', id, '.gz') AS path", "concat('d', id % 2) AS _in_date", "cast(id AS int) AS version"
    )
    dropped = versions.superseded_versions(listing)
    assert "WindowGroupLimit" in plan(dropped) and "Partial" in plan(dropped)
    assert dropped.count() == 994


def test_enrichment_joins_distinct_aircraft(spark, hot_pings):
    registry = spark.sql(
        "SELECT 'hot' AS icao, 'ACME' AS owner, '' AS manufacturer, 'M' AS model, true AS is_current"
    )
    got = fleet.enriched_aircraft(hot_pings, registry)
    assert got.count() == got.distinct().count()
    assert got.where("icao = 'hot' AND owner = 'ACME' AND manufacturer IS NULL").count() > 0
    upper = registry.withColumn("icao", F.upper("icao"))
    folded = fleet.enriched_aircraft(hot_pings, upper, normalize_icao=True)
    assert folded.where("owner = 'ACME'").count() == got.where("owner = 'ACME'").count()
    assert fleet.enriched_aircraft(hot_pings, upper).where("owner = 'ACME'").count() == 0


def test_counting_rows_reads_no_column(spark, hot_pings, tmp_path):
    path = str(tmp_path / "t")
    hot_pings.write.parquet(path)
    counted = tables.count_rows(spark, path)
    assert "ReadSchema: struct<>" in plan(counted)
    assert counted.first()["rows"] == 40_000


def test_expected_files_and_dates(spark):
    days = spark.sql("SELECT DATE '2023-11-01' AS day")
    names = rows(listings.snapshot_names(days, limit=17280))
    assert names[0] == ("20231101", "000000Z.json.gz") and names[1][1] == "000005Z.json.gz"
    assert names[-1][1] == "235955Z.json.gz" and len(names) == 17280
    assert listings.snapshot_names(days, limit=0).count() == 0
    dates = rows(listings.run_dates(spark))
    assert len(dates) == 13
    assert dates[0] == ("2023-11-01", "20231101") and dates[-1] == ("2024-11-01", "20241101")


def test_index_page_links(spark):
    html = "<a href=\"../\">..</a>\n" + "\n".join(
        f'<a href="{n:03d}Z.json.gz">x</a> <i>' for n in range(150, 0, -1)
    )
    got = listings.index_links(spark.createDataFrame([("d", html)], "day string, html string"), keep=("day",))
    assert rows(got) == [("d", f"{n:03d}Z.json.gz") for n in range(1, 151)]
    first = listings.index_links(
        spark.createDataFrame([("d", html)], "day string, html string"), keep=("day",), limit=100
    )
    assert first.count() == 100


def test_counting_files_does_not_parse_again(spark, bronze):
    docs = snapshots.scan_snapshot_bytes(spark, bronze)
    watched = docs.observe(Observation(), F.count_if(snapshots.is_usable()).alias("ok"))
    text = plan(normalize(snapshots.flatten(watched, keep=()), "zero_fill"))
    assert text.count("ArrowEvalPython") == 1 and text.count("from_json(") == 1


def test_catalog_table_is_replaced(spark, hot_pings, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION '{tmp_path}/lake'")
    try:
        for rows_kept in (hot_pings, hot_pings.where("icao = 'hot'")):
            refresh_table(rows_kept, "lake.pings", partition="_in_date")
        assert spark.table("lake.pings").count() == 20_000
    finally:
        spark.sql("DROP DATABASE lake CASCADE")


def test_grouping_many_aircraft_is_not_left_to_one_task(spark):
    """Some 40 MB of shuffled rows, below Spark's own advisory size."""
    ids = spark.range(1_500_000, numPartitions=4)
    pings = ids.selectExpr(
        "substr(sha1(string(id)), 1, 12) AS icao", "'20240101' AS source_date", "substr(sha1(string(-id)), 1, 4) AS type"
    )
    tasks = emissions.pings_by_type(pings).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1
