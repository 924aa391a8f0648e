"""Cases in which jobs lost, kept or invented rows."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from aerolake.plans import pings, registry
from aerolake.session import require
from aerolake.sinks import archive_bytes, write_prepared_csv, write_tsv
from aerolake.sources import fuel, snapshots, tables
from aerolake.sources.paths import entries

from tests.conftest import rows, write_snapshots

GOOD = b'{"now":1698796800,"aircraft":[{"hex":"a1"}]}'
REFUSED = {
    "trail.json": GOOD + b" trailing",
    "two.json": GOOD + b"\n" + GOOD,
    "list.json": b"[" + GOOD + b"," + GOOD + b"]",
    "mark.json": b"\xef\xbb\xbf" + GOOD,
    "empty.json": b"",
    "comma.json": GOOD + b"," + GOOD,
}


@pytest.mark.parametrize("any_payload", [True, False])
def test_days_without_pings(spark, tmp_path, any_payload):
    bronze, silver, gold = (str(tmp_path / n) for n in ("b", "s", "g"))
    write_snapshots(tmp_path / "b", "_in_date", {"a.json": b"{"}, day="20231101")
    write_snapshots(tmp_path / "b", "_in_date", {"a.json": b'{"now":1,"aircraft":[]}'}, day="20231102")
    for day, counts in (("2023-11-01", (0, 1)), ("2023-11-02", (1, 0)), ("2023-11-03", (0, 0))):
        report = pings.run_pings(spark, bronze, silver, gold, [day], any_payload=any_payload)
        assert (report.files_ok, report.files_failed) == counts
        assert report.gold.total_records == 0


@pytest.mark.parametrize("any_payload", [True, False])
def test_a_good_day_that_turned_bad_is_emptied_and_others_stay(spark, tmp_path, any_payload):
    bronze, silver, gold = (str(tmp_path / n) for n in ("b", "s", "g"))
    for day in ("20231101", "20231102", "20231103"):
        write_snapshots(tmp_path / "b", "_in_date", {"a.json": GOOD}, day=day)
    pings.run_pings(spark, bronze, silver, gold, any_payload=any_payload)
    assert pings.read_gold(spark, gold).count() == 3
    write_snapshots(tmp_path / "b", "_in_date", {"a.json": b"{"}, day="20231102")
    pings.run_pings(spark, bronze, silver, gold, ["2023-11-02", "2023-11-03"], any_payload=any_payload)
    left = rows(pings.read_gold(spark, gold).select("source_date"))
    assert left == [("20231101",), ("20231103",)]


def test_both_readers_refuse_the_same_files(spark, tmp_path):
    root = write_snapshots(tmp_path / "b", "_in_date", {**REFUSED, "good.json": b" " + GOOD + b"\n"})
    for scan in (snapshots.scan_snapshots, snapshots.scan_snapshot_bytes):
        docs = scan(spark, root)
        assert docs.count() == len(REFUSED) + 1
        assert docs.where(snapshots.is_usable()).count() == 1


def test_archive_is_read_like_the_files(spark, tmp_path):
    root = write_snapshots(
        tmp_path / "b", "_in_date", {"a.json": GOOD, "b.json": gzip.compress(GOOD), "c.json": b"{"}
    )
    from aerolake.operators.versions import scan_files

    archive = str(tmp_path / "archive")
    archive_bytes(scan_files(spark, root), archive)
    docs = snapshots.scan_archive(spark, archive, ["20231101"])
    assert docs.count() == 3 and docs.where(snapshots.is_usable()).count() == 2
    assert snapshots.scan_archive(spark, archive, ["20240101"]).count() == 0


def test_repeated_keys_keep_the_last(spark):
    one = spark.createDataFrame([('{"X":{"galph":1},"Y":{"galph":3},"X":{"galph":2}}',)], "t string")
    assert rows(fuel.fuel_rates(one, "t").select("aircraft_type", "galph")) == [("X", 2.0), ("Y", 3.0)]
    text = spark.createDataFrame([('{"a":1,"a":2}',), ('{a:1,"a":3}',), ('{"a":1} x',)], "t string")
    found = text.select(F.try_variant_get(snapshots.lenient_json("t"), "$.a", "int").alias("a"))
    assert rows(found) == [(None,), (2,), (3,)]


AWKWARD = ["", None, "\\N", "\\t", "a\tb", "l1\nl2", "r\r", "\\", 'q"u', "x,NULL,y", " pad ", "NULL", "{}"]


def test_tsv_comes_back_as_it_was(spark, tmp_path):
    data = [(i, s, [s, "z"], None if i % 2 else [s]) for i, s in enumerate(AWKWARD)] + [(99, "e", [], [])]
    df = spark.createDataFrame(data, "i int, s string, a array<string>, b array<string>")
    write_tsv(df, str(tmp_path / "t"))
    back = tables.read_tsv(spark, str(tmp_path / "t"), df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(data)


def test_csv_keeps_line_ends(spark, tmp_path):
    texts = [s or "" for s in AWKWARD if s != "r\r"] + ["l1\r\nl2"]
    df = spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)], "icao string, type string")
    write_prepared_csv(df, str(tmp_path / "c"), ["icao", "type"])
    back = tables.read_prepared_csv(spark, str(tmp_path / "c"), df.schema)
    assert rows(back) == rows(df)


def test_jdbc_in_one_task_must_be_asked_for(spark):
    with pytest.raises(ValueError):
        tables.read_jdbc(spark, "jdbc:x:", "t", split_column="id")


def test_settings_are_checked(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(RuntimeError):
            require(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def deliver(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("\n".join(map(json.dumps, records)).encode()))
    return str(path)


def test_landed_registry_runs_through(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("b", "s", "g"))
    first = [{"icao": "a1", "ownop": "X"}, {"icao": "a2", "ownop": "Y"}, {"icao": "a2", "ownop": "Z"}]
    for n, records in enumerate((first, first, []), 1):
        path = registry.land(spark, deliver(tmp_path / "in" / f"{n}.json.gz", records), bronze, "2023-11-01")
        assert path.endswith(f"_v{n}.jsonl")
        written = registry.landed_to_silver(spark, bronze, silver, "2023-11-01")
        assert written.endswith(f"version={n}")
        report = registry.to_gold(spark, written, gold, "2023-11-01")
        assert (report.version, report.opened, report.duplicates) == ((1, 2, 1), (None, 0, 1), (None, 0, 0))[n - 1]
    assert registry.newest_silver(spark, silver, "2023-11-01").endswith("version=3")
    assert spark.read.parquet(f"{bronze}/_manifest").count() == 3
    assert registry.superseded(spark, bronze, "2023-11-01").count() == 0
    with pytest.raises(ValueError):
        registry.to_gold(spark, f"{silver}/_in_date=20231101/version=1", gold, "2023-11-01", refuse_duplicates=True)


def test_history_folders_do_not_grow_with_loads(spark, tmp_path):
    from aerolake import sinks

    silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
    names = ("reg", "icaotype", "manufacturer", "model", "owner", "short_type")
    for n in range(1, 7):
        made = spark.range(4).select(
            F.col("id").cast("string").alias("icao"),
            *[F.lit("v").alias(c) for c in names if c != "owner"],
            F.when(F.col("id") == n % 4, F.lit(f"o{n}")).otherwise("o").alias("owner"),
            F.lit(2000).cast("bigint").alias("year"),
            *[F.lit(False).alias(c) for c in ("faa_pia", "faa_ladd", "mil")],
        )
        path = sinks.write_versioned(made, silver, "20231101", n)
        assert registry.to_gold(spark, path, gold, "2023-11-01").version == n
        assert registry.to_gold(spark, path, gold, "2023-11-01").version is None
    assert len(entries(spark, f"{gold}/rows/_load=*/is_current=true")) == 2
    assert len(entries(spark, f"{gold}/rows/_load=*")) == 6
    stored = registry.read_history(spark, gold)
    assert stored.where("is_current").count() == 4 and stored.count() > 8
