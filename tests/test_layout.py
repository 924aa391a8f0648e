"""Listing, landing, paging and lookups whose cost must not grow with what they pass by."""

import gzip
import hashlib
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerolake import sinks
from aerolake.operators import fleet, paging
from aerolake.plans import pings, registry
from aerolake.sources import snapshots
from aerolake.sources.paths import layer_files, listed
from tests.conftest import rows, write_snapshots

GOOD = b'{"now":1698796800,"aircraft":[{"hex":"a1"}]}'


class Calls:
    """Counts what Python asks of the JVM."""

    def __init__(self, spark):
        self.client, self.n = spark._sc._gateway._gateway_client, 0
        self.send = self.client.send_command

    def __enter__(self):
        def counted(*args, **kwargs):
            self.n += 1
            return self.send(*args, **kwargs)

        self.client.send_command = counted
        return self

    def __exit__(self, *_):
        self.client.send_command = self.send


def test_driver_calls_do_not_grow_with_files(spark, tmp_path):
    calls = {}
    for n in (20, 2_000):
        files = {f"{i:06d}Z.json": b"" if i % 10 == 0 else GOOD for i in range(n)}
        bronze = write_snapshots(tmp_path / f"b{n}", "_in_date", files)
        with Calls(spark) as seen:
            report = pings.run_pings(spark, bronze, str(tmp_path / f"s{n}"), str(tmp_path / f"g{n}"), ["2023-11-01"])
            # the second run also looks for days to empty
            pings.run_pings(spark, bronze, str(tmp_path / f"s{n}"), str(tmp_path / f"g{n}"), ["2023-11-01"])
        calls[n] = seen.n
        assert (report.files_ok, report.files_failed) == (n * 9 // 10, n // 10)
    assert calls[2_000] < calls[20] + 1_000


def test_files_are_listed_by_day_with_odd_names(spark, tmp_path):
    root = write_snapshots(tmp_path / "b", "_in_date", {"a b.json": b"", "ü%41.json": GOOD, "c.json": GOOD})
    write_snapshots(tmp_path / "b", "_in_date", {"d.json": b"", "_hidden": b"x"}, day="20231102")
    (tmp_path / "b" / "outside.json").write_bytes(GOOD)
    found = layer_files(spark, root, None)
    assert rows(found.groupBy("_in_date").count()) == [("20231101", 3), ("20231102", 1)]
    assert layer_files(spark, root, ["20231102"]).count() == 1
    assert layer_files(spark, root, ["20240101"]) is None
    for scan in (snapshots.scan_snapshots, snapshots.scan_snapshot_bytes):
        docs = scan(spark, root, ["20231101", "20231102"])
        assert docs.count() == 4 and docs.where(snapshots.is_usable()).count() == 2
        assert scan(spark, root, ["20231101"], with_empty=False).count() == 2
    assert listed(spark.read.format("binaryFile").load(root)).count() == 5


def test_text_that_closes_the_list_early_is_refused(spark):
    texts = [GOOD.decode() + tail for tail in ("", "]", "]}", ']} {"docs":[', '],"x":1}', "}", ",", ' ,{"now":1}')]
    texts += ["{", "{}", '{"aircraft":3}', '{"now":"x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    docs = snapshots.parse_documents(df, "t")
    usable = rows(docs.where(snapshots.is_usable()).select("i"))
    assert usable == [(0,), (texts.index("{}"),)]


RETRY = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F, types as T
from aerolake.plans import pings
from aerolake.session import configure
from aerolake.sources import snapshots

spark = configure(
    SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.sql.warehouse.dir", sys.argv[2] + "/w").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
inflate = snapshots.gunzip.func

def once(content):
    out = inflate(content)
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
    return out

snapshots.gunzip = F.pandas_udf(once, T.BinaryType())
root = sys.argv[2]
report = pings.run_pings(spark, root + "/b", root + "/s", root + "/g", ["2023-11-01"])
print(json.dumps([report.files_ok, report.files_failed, report.gold.total_records]))
"""


def test_a_task_that_runs_again_counts_once(tmp_path):
    files = {f"{i}.json.gz": gzip.compress(GOOD) for i in range(7)} | {"bad.json.gz": gzip.compress(b"{"), "e": b""}
    write_snapshots(tmp_path / "b", "_in_date", files)
    script = tmp_path / "run.py"
    script.write_text(RETRY.replace("from pyspark.sql import SparkSession, functions", "import pandas as pd\nfrom pyspark.sql import SparkSession, functions").replace("def once(content):", "def once(content: pd.Series) -> pd.Series:"))
    repo = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": repo}
    run = subprocess.run(
        [sys.executable, str(script), repo, str(tmp_path)], capture_output=True, text=True, timeout=240, env=env
    )
    assert run.returncode == 0, run.stderr[-2_000:]
    assert json.loads(run.stdout.strip().splitlines()[-1]) == [7, 2, 7]


def test_outcomes_of_other_days_stay(spark, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    for day in ("20231101", "20231102"):
        write_snapshots(tmp_path / "b", "_in_date", {"a.json": GOOD, "b.json": b"{", "c.json": b""}, day=day)
    report = pings.to_silver(spark, bronze, silver)
    assert (report.files_ok, report.files_failed) == (2, 4)
    (tmp_path / "b" / "_in_date=20231102" / "b.json").write_bytes(GOOD)
    report = pings.to_silver(spark, bronze, silver, ["2023-11-02"])
    assert (report.files_ok, report.files_failed) == (2, 1)
    found = pings.read_outcomes(spark, silver).groupBy("_in_date").agg(F.count_if("ok"), F.count("*"))
    assert rows(found) == [("20231101", 1, 3), ("20231102", 2, 3)]


# --- paging --------------------------------------------------------------------------


def test_every_page_from_ranges_is_that_of_the_whole_order(spark):
    data = [(i * 7919 % 1009 % 200, f"t{i % 13}", None if i % 50 == 0 else i) for i in range(1_000)]
    df = spark.createDataFrame(data, "a int, b string, c int").repartition(5)
    order = ["a", "b", "c"]
    whole = [tuple(r) for r in df.orderBy(*order).collect()]
    pages = paging.ranged(df, order, ranges=6)
    assert pages.starts[-1] == 1_000 and len(pages.starts) > 4
    for size, number in ((1, 0), (1, 999), (7, 3), (100, 9), (333, 2), (333, 3), (5_000, 0), (10, -4), (10, 100), (0, 1)):
        got = [tuple(r) for r in pages.page(size, number).collect()]
        at = max(number, 0) * size
        assert got == whole[at : at + size]


def test_deep_page_reads_its_range_only(spark, monkeypatch):
    monkeypatch.setattr(paging, "NEAR", 1_000)
    df = spark.range(200_000).select(F.xxhash64("id").alias("h"), "id")
    whole = [r[0] for r in df.orderBy("h", "id").select("id").collect()]
    found = paging.page(df, 50, 3_000, ["h", "id"])
    assert [r["id"] for r in found.collect()] == whole[150_000:150_050]
    pages = paging.ranged(df, ["h", "id"], ranges=40)
    read = pages.page(50, 3_000)
    folders = {p.split("/_range=")[1].split("/")[0] for p in read.inputFiles()}
    assert folders  # of the listing; what is read is in the plan
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    rows_read = pages.rows.where("_range = 30").count()
    assert rows_read < 15_000


def test_pages_of_an_empty_frame(spark):
    df = spark.range(10).where("id > 100")
    assert paging.ranged(df, ["id"]).page(10, 0).count() == 0


# --- one aircraft --------------------------------------------------------------------


def test_one_aircraft_opens_one_bucket_of_each_day(spark, tmp_path):
    seen = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', lpad(hex(id % 997), 6, '0')) AS icao",
        "cast(id AS int) AS alt_baro",
        "cast(id % 400 AS double) AS ground_speed",
        "timestamp_seconds(1698796800 + id * 10) AS timestamp",
        "'none' AS emergency",
        "date_format(timestamp_seconds(1698796800 + id * 10), 'yyyyMMdd') AS source_date",
    )
    name = "gold_by_aircraft"
    sinks.write_bucketed(seen, name, partition="source_date", buckets=16)
    table = spark.table(name)
    for icao in ("hot", "00002A"):
        found = fleet.stats(table, icao)
        assert "SelectedBucketsCount: 1 out of 16" in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(fleet.stats(seen, icao))
    days = seen.select("source_date").distinct().count()
    opened = table.where("icao = 'hot'").select("_metadata.file_path").distinct().count()
    files = len(table.inputFiles())
    assert opened == days and files > 8 * days
    spark.sql(f"DROP TABLE {name}")


def test_gold_table_replaces_its_days(spark, tmp_path):
    silver = str(tmp_path / "s")
    for day in ("20231101", "20231102"):
        write_snapshots(tmp_path / "b", "_in_date", {"a.json": GOOD}, day=day)
    pings.to_silver(spark, str(tmp_path / "b"), silver)
    report = pings.gold_table(spark, silver, "gold_days", buckets=4)
    assert (report.total_records, report.unique_dates) == (2, 2)
    again = pings.gold_table(spark, silver, "gold_days", ["2023-11-02"], buckets=4)
    assert (again.total_records, again.unique_dates) == (1, 1)
    assert spark.table("gold_days").count() == 2
    spark.sql("DROP TABLE gold_days")


# --- landing -------------------------------------------------------------------------


def lines(n):
    return "".join(json.dumps({"icao": f"{i:06x}", "ownop": f"owner {i}" * 5}) + "\n" for i in range(n)).encode()


def test_landed_files_are_the_delivered_bytes_and_read_by_lines(spark, tmp_path):
    data = lines(20_000)
    source = tmp_path / "in" / "delivery.json"
    source.parent.mkdir()
    source.write_bytes(data)
    bronze = str(tmp_path / "bronze")
    folder = registry.land(spark, str(source), bronze, "2023-11-01")
    manifest = spark.read.parquet(f"{bronze}/_manifest").first()
    assert manifest["file_hash"] == hashlib.sha256(data).hexdigest() and manifest["size"] == len(data)
    assert Path(manifest["path"].removeprefix("file:")).read_bytes() == data
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        from aerolake.sources.registry import scan_registry_lines

        read = scan_registry_lines(spark, folder)
        assert read.rdd.getNumPartitions() > 5 and read.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_names_follow_the_content(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plain.json.gz").write_bytes(lines(3))
    (folder / "packed.json").write_bytes(gzip.compress(lines(4)) + gzip.compress(lines(2)))
    (folder / "_SUCCESS").write_bytes(b"")
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    landed = registry.land(spark, str(folder), bronze, "2023-11-01")
    assert sorted(p.name for p in Path(landed).iterdir() if p.name[0] != ".") == ["packed.json.gz", "plain.json"]
    written = registry.landed_to_silver(spark, bronze, silver, "2023-11-01")
    assert spark.read.parquet(written).count() == 9


def test_nothing_delivered_is_an_error_and_leaves_no_version(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        registry.land(spark, str(tmp_path / "none"), str(tmp_path / "b"), "2023-11-01")
    assert registry.landed(spark, str(tmp_path / "b"), "2023-11-01").count() == 0
