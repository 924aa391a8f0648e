import csv
import gzip
import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerolake.operators import history, versions
from aerolake.operators.emissions import co2
from aerolake.operators.fleet import list_aircraft, list_enriched, stats
from aerolake.plans import fuel, pings, prepare, registry
from aerolake.sinks import write_tsv
from aerolake.sources import tables
from aerolake.sources.registry import registry_records, scan_registry_lines
from tests.conftest import SNAPSHOT_FILES, rows, write_lines, write_snapshots

T1 = datetime(2023, 11, 1, 6, tzinfo=timezone.utc)
T2 = datetime(2023, 11, 2, 6, tzinfo=timezone.utc)
LOAD_1 = [
    {"icao": "a1", "reg": "N1", "ownop": "ACME", "year": "2010"},
    {"icao": "a2", "reg": "N2", "ownop": "BETA", "year": None},
    {"icao": "a4", "reg": "N4", "ownop": ""},
]
LOAD_2 = [
    {"icao": "a1", "reg": '"N1"', "ownop": "ACME", "year": "2010"},
    {"icao": "a2", "reg": "N2", "ownop": "GAMMA", "year": None},
    {"icao": "a3", "reg": "N3"},
]
FUEL = {
    "GLF6": {"name": "G650", "galph": 503, "category": "ULR", "source": "x"},
    "C172": {"galph": "n/a"},
    "B738": {"name": "737"},
    "A320": {"galph": None, "name": None},
    "E190": {"galph": "400.5"},
}


def load_registry(spark, tmp_path, day, records, at, version=1):
    bronze = tmp_path / "bronze"
    compact = day.replace("-", "")
    write_lines(bronze / f"_in_date={compact}" / f"aircrafts_database_v{version}.json.gz", records)
    return registry.run_registry(
        spark, str(bronze), str(tmp_path / "silver"), str(tmp_path / "gold"), day, at
    )


def test_registry_history(spark, tmp_path):
    gold = str(tmp_path / "gold")
    assert registry.read_history(spark, gold).count() == 0
    first = load_registry(spark, tmp_path, "2023-11-01", LOAD_1 + ["{broken"], T1)
    assert (first.version, first.opened, first.closed) == (1, 3, 0)

    second = load_registry(spark, tmp_path, "2023-11-02", LOAD_2, T2)
    assert (second.version, second.opened, second.closed) == (2, 2, 1)
    stored = registry.read_history(spark, gold)
    shown = rows(stored.select("icao", "reg", "owner", "version", "is_current", "valid_from", "valid_to"))
    t1, t2 = (t.replace(tzinfo=None) for t in (T1, T2))
    assert shown == [
        ("a1", "N1", "ACME", 1, True, t1, None),
        ("a2", "N2", "BETA", 1, False, t1, t2),
        ("a2", "N2", "GAMMA", 2, True, t2, None),
        ("a3", "N3", "", 2, True, t2, None),
        ("a4", "N4", "", 1, True, t1, None),
    ]
    kept, opened = (
        stored.where(f"icao = '{i}'").first()["_file_location"] for i in ("a1", "a3")
    )
    assert "_in_date=20231101/version=1" in kept and "_in_date=20231102/version=1" in opened

    # The same delivery again: next silver version, no gold version.
    again = load_registry(spark, tmp_path, "2023-11-02", LOAD_2, T2, version=2)
    assert again.version is None
    assert (tmp_path / "silver" / "_in_date=20231102" / "version=2").is_dir()
    assert rows(stored) == rows(registry.read_history(spark, gold))
    assert registry.read_loads(spark, gold).count() == 2

    # What a broken load leaves behind is not seen, and the next try replaces it.
    stray = stored.where("not is_current").withColumn("icao", F.lit("stray"))
    stray.write.mode("overwrite").partitionBy("is_current").parquet(f"{gold}/rows/_load=3/")
    assert registry.read_history(spark, gold).where("icao = 'stray'").count() == 0
    third = load_registry(spark, tmp_path, "2023-11-03", [{"icao": "a9"}], T2)
    assert (third.version, third.opened, third.closed) == (3, 1, 0)
    after = registry.read_history(spark, gold)
    assert after.count() == 6 and after.where("icao = 'stray'").count() == 0


def test_merge_equals_its_parts(spark):
    schema = history.REGISTRY

    def records(*items):
        full = [{**{f.name: "" for f in schema if f.dataType.typeName() == "string"},
                 "year": None, "faa_pia": False, "faa_ladd": False, "mil": False, **i} for i in items]
        return spark.createDataFrame(full, schema)

    from aerolake.schemas import REGISTRY_GOLD

    empty = spark.createDataFrame([], REGISTRY_GOLD)
    one = history.merge(
        empty,
        records({"icao": "a", "owner": "x"}, {"icao": "b", "owner": " q\\tr "}, {"icao": "c", "mil": True}),
        loaded_at=T1, source_date="20231101",
    )
    incoming = records(
        {"icao": "a", "owner": "y"}, {"icao": "b", "owner": "'q\tr'"}, {"icao": "c", "mil": False},
        {"icao": "d"}, {"icao": "d", "owner": "copy"},
    )
    two = history.merge(one, incoming, loaded_at=T2, source_date="20231102")

    load = history.one_row_per_key(incoming)
    assert rows(load.where("copies > 1").select("icao", "owner", "copies")) == [("d", "", 2)]
    changed = history.classify(load.drop("copies"), one)
    assert rows(changed.select("icao", "change")) == [
        ("a", "changed"), ("b", "same"), ("c", "changed"), ("d", "new"),
    ]
    closed = history.close_rows(one, changed.where("change <> 'same'"), T2)
    shown = ["icao", "owner", "mil", "valid_to", "is_current"]
    opened = changed.where("change <> 'same'").select(
        "icao", "owner", "mil", F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current")
    )
    assert rows(two.select(*shown)) == rows(closed.select(*shown).union(opened))
    assert {r[0] for r in two.select("version").distinct().collect()} == {1, 2}


def test_registry_lines(spark, tmp_path):
    path = write_lines(
        tmp_path / "r.json.gz",
        [{"icao": "a", "year": "n/a", "faa_pia": True, "mil": "false"}, "oops", {"icao": "b", "year": 1999}],
    )
    got = registry_records(scan_registry_lines(spark, path))
    assert rows(got.select("icao", "reg", "owner", "year", "faa_pia", "mil", "faa_ladd")) == [
        ("a", "", "", None, True, False, False),
        ("b", "", "", 1999, False, False, False),
    ]


def test_missing_registry_file_raises(spark, tmp_path):
    folder = tmp_path / "bronze" / "_in_date=20231101"
    folder.mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        registry.to_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "s"), "2023-11-01")


def run_fuel(spark, tmp_path):
    source = tmp_path / "fuel.json"
    source.write_text(json.dumps(FUEL, indent=1))
    gold = str(tmp_path / "fuel_gold")
    fuel.run_fuel(spark, str(source), str(tmp_path / "fuel_silver"), gold)
    return fuel.read_gold(spark, gold)


def test_fuel_job(spark, tmp_path):
    gold = run_fuel(spark, tmp_path)
    assert rows(gold.select("aircraft_type", "name", "galph", "category")) == [
        ("A320", "", None, ""),
        ("B738", "737", 0.0, ""),
        ("C172", "", None, ""),
        ("E190", "", 400.5, ""),
        ("GLF6", "G650", 503.0, "ULR"),
    ]
    lineage = gold.select("_file_location", "_systems_passed").first()
    assert "fuel_silver" in lineage[0] and lineage[1] == ["bronze", "silver", "gold"]


def test_pings_job_and_questions(spark, tmp_path):
    bronze = write_snapshots(tmp_path / "bronze", "_in_date", SNAPSHOT_FILES)
    write_snapshots(
        tmp_path / "bronze", "_in_date",
        {"000000Z.json.gz": b'{"now":1701388800,"aircraft":[{"hex":"a1","t":"GLF6"}]}'},
        day="20231201",
    )
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    days = ["2023-11-01", "2023-12-01", "2024-01-01"]
    report = pings.run_pings(spark, bronze, silver, gold, days)
    assert (report.files_ok, report.files_failed, report.files_total) == (6, 1, 7)
    stored = pings.read_gold(spark, gold)
    assert stored.groupBy("source_date").count().orderBy("source_date").collect() == [
        ("20231101", 7), ("20231201", 1),
    ]
    before = rows(stored.drop("_loaded_time", "_file_location"))

    # Again, whole and by day: the same rows.
    pings.run_pings(spark, bronze, silver, gold, days)
    pings.run_pings(spark, bronze, silver, gold, ["2023-12-01"], refresh=False)
    stored = pings.read_gold(spark, gold)
    assert rows(stored.drop("_loaded_time", "_file_location")) == before
    assert pings.read_gold(spark, gold, ["2023-12-01"]).count() == 1
    assert (report.gold.total_records, report.gold.unique_aircraft, report.gold.unique_dates) == (8, 4, 2)

    rates = run_fuel(spark, tmp_path)
    assert rows(co2(stored, rates, "a1", "2023-11-01")) == [("a1", "2023-11-01", 0.004167, 0.022125)]
    assert rows(co2(stored, rates, "a2", "2023-11-01")) == [("a2", "2023-11-01", 0.002778, None)]
    assert rows(co2(stored, rates, "zz", "2023-11-01")) == [("zz", "2023-11-01", 0.0, None)]
    for bad in ("2023-02-30", "20231101"):
        with pytest.raises(ValueError):
            co2(stored, rates, "a1", bad)

    load_registry(spark, tmp_path / "reg", "2023-11-01", LOAD_1, T1)
    known = registry.read_history(spark, str(tmp_path / "reg" / "gold"))
    listed = rows(list_enriched(stored, known))
    assert ("a1", "N1", "GLF6", "ACME", None, None) in listed
    assert ("a2", "", "", "BETA", None, None) in listed
    assert all(r[0] for r in listed)


def test_pings_job_by_spark_reader(spark, tmp_path):
    bronze = write_snapshots(tmp_path / "bronze", "_in_date", SNAPSHOT_FILES)
    silver = str(tmp_path / "silver")
    report = pings.to_silver(spark, bronze, silver, any_payload=False)
    assert (report.files_ok, report.files_failed) == (4, 2)
    assert tables.read_layer(spark, silver, pings.PINGS_SILVER).count() == 6


def test_prepare_csv_twice(spark, raw, tmp_path):
    out = str(tmp_path / "prepared")
    path = prepare.prepare_csv(spark, raw, out, "2023-11-01")
    first = rows(tables.read_prepared_csv(spark, path))
    assert len(first) == 6
    part = next(p for p in sorted(Path(path).glob("part-*")) if p.read_text().count("\n") > 3)
    lines = list(csv.DictReader(part.open()))
    assert list(lines[0]) == [
        "icao", "registration", "type", "lat", "lon", "alt_baro", "timestamp", "ground_speed", "emergency",
    ]
    a2 = next(r for r in lines if r["icao"] == "a2")
    assert (a2["registration"], a2["alt_baro"], a2["lat"]) == ("", "1200.7", "")
    prepare.prepare_csv(spark, raw, out, "2023-11-01")
    assert rows(tables.read_prepared_csv(spark, path)) == first

    text = tables.read_prepared_csv(spark, path)
    assert rows(list_aircraft(text, mode="last_wins")) == [("a1", "N1", "GLF6")]
    assert rows(stats(text, "a1", "lenient")) == [("a1", 35000.0, 450.1, True)]

    whole = prepare.prepare_csv(spark, raw, out, "2023-11-01", profile="int_or_null", any_payload=True)
    altitudes = {r[0] for r in tables.read_prepared_csv(spark, whole).select("alt_baro").collect()}
    assert altitudes == {"", "1200", "-75", "35000", "1300"}


def test_prepare_table(spark, raw, tmp_path):
    path = str(tmp_path / "table")
    prepare.load_table(spark, raw, "2023-11-01", path)
    prepare.load_table(spark, raw, "2023-11-01", path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    assert stored.where("registration = ''").count() == 0
    assert stored.schema["alt_baro"].dataType.typeName() == "integer"
    assert prepare.prepare_table(spark, raw, "2024-05-05").count() == 0


def test_tsv_text(spark, tmp_path):
    path = str(tmp_path / "tsv")
    df = spark.createDataFrame(
        [("a\tb", None, 'say "hi"', ["x", "y"], " pad "), ("", 2, "l1\nl2", [], "z")],
        "s string, n int, q string, l array<string>, p string",
    )
    write_tsv(df.coalesce(1), path)
    lines = next(Path(path).glob("part-*")).read_text().splitlines()
    assert sorted(lines) == sorted(
        ["a\\tb\t\\N\tsay \"hi\"\t{\"x\",\"y\"}\t pad ", "\t2\tl1\\nl2\t{}\tz"]
    )


def test_versions(spark):
    names = [(f"b/aircrafts_database_v{n}.json.gz", "d1", n) for n in (2, 9, 10, 11)]
    listing = spark.createDataFrame(names, "path string, _in_date string, version int")
    assert versions.latest_version(listing).first()["version"] == 11
    wanted = spark.createDataFrame([("d1",), ("d2",)], "_in_date string")
    assert rows(versions.next_version(listing, wanted)) == [("d1", 12), ("d2", 1)]
    assert [r["version"] for r in versions.superseded_versions(listing).collect()] == [2]
    assert versions.superseded_versions(listing, 0).count() == 4
    none = listing.withColumn("_in_date", F.lit(None).cast("string"))
    assert [r["version"] for r in versions.superseded_versions(none).collect()] == [2]


def test_manifest_of_files(spark, tmp_path):
    folder = tmp_path / "b" / "_in_date=20231101"
    folder.mkdir(parents=True)
    (folder / "aircrafts_database_v3.json.gz").write_bytes(gzip.compress(b"{}", mtime=0))
    listed = versions.manifest(versions.scan_files(spark, str(tmp_path / "b")), source="s").first()
    import hashlib

    assert listed["file_hash"] == hashlib.sha256(gzip.compress(b"{}", mtime=0)).hexdigest()
    assert (listed["version"], listed["_in_date"], listed["source"]) == (3, "20231101", "s")
