from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerolake.functions import files, numbers, times
from aerolake.operators.fleet import list_aircraft, positions, stats
from aerolake.operators.normalize import gold_pings, normalize, typed_table
from aerolake.operators.quality import file_outcomes, outcome_totals
from aerolake.sources import snapshots
from tests.conftest import rows, write_snapshots


def by_json(spark, root):
    return snapshots.scan_snapshots(spark, root)


def by_bytes(spark, root):
    return snapshots.scan_snapshot_bytes(spark, root)


def test_json_scan_counts(spark, bronze):
    docs = by_json(spark, bronze)
    totals = outcome_totals(file_outcomes(docs)).first()
    assert totals.asDict() == {"files_ok": 4, "files_failed": 2, "files_total": 6, "pings": 6}
    assert snapshots.flatten(docs).count() == 6
    assert {r[0] for r in docs.select("_in_date").collect()} == {"20231101"}


def test_bytes_scan_counts(spark, bronze):
    docs = by_bytes(spark, bronze)
    totals = outcome_totals(file_outcomes(docs)).first()
    assert totals.asDict() == {"files_ok": 5, "files_failed": 1, "files_total": 6, "pings": 7}
    assert snapshots.flatten(docs).count() == 7
    bad = file_outcomes(docs).where("not ok").first()["file_path"]
    assert bad.endswith("000015Z.json")


@pytest.mark.parametrize("scan", [by_json, by_bytes])
def test_day_without_files_is_empty(spark, bronze, scan):
    scan = snapshots.scan_snapshots if scan is by_json else snapshots.scan_snapshot_bytes
    assert scan(spark, bronze, ["20240101"]).count() == 0
    assert snapshots.flatten(scan(spark, bronze, ["20231101", "20240101"])).count() >= 6


def test_name_glob(spark, bronze):
    docs = snapshots.scan_snapshots(spark, bronze, name_glob="*.gz")
    assert docs.count() == 1


@pytest.mark.parametrize(
    "content",
    [
        b'{"now": null, "aircraft": [{"hex":"x"}]}',
        b'{"now": "1698796800", "aircraft": [{"hex":"x"}]}',
        b'{"now": 1, "aircraft": {"hex":"x"}}',
        b'{"now": 1, "aircraft": [null]}',
        b'{"now": 1, "aircraft": null}',
        b"",
        b"\x1f\x8b broken",
    ],
)
@pytest.mark.parametrize("scan", [by_json, by_bytes])
def test_bad_file_gives_no_rows_and_others_survive(spark, tmp_path, scan, content):
    good = b'{"aircraft": [{"hex":"ok"}]}'
    root = write_snapshots(tmp_path / "b", "_in_date", {"1Z.json": content, "2Z.json": good})
    flat = snapshots.flatten(scan(spark, root))
    assert rows(flat.select("icao", "timestamp")) == [("ok", datetime(1970, 1, 1))]


def test_damaged_utf8_is_replaced(spark, tmp_path):
    content = b'{"now": 5, "aircraft": [{"hex":"a\xff1"}]}'
    root = write_snapshots(tmp_path / "b", "_in_date", {"1Z.json": content})
    assert rows(snapshots.flatten(by_bytes(spark, root)).select("icao")) == [("a�1",)]


def altitudes(spark, root, profile, icao="a1"):
    pings = normalize(snapshots.flatten(by_bytes(spark, root)), profile)
    return [r[0] for r in pings.where(F.col("icao") == icao).orderBy("timestamp").select("alt_baro").collect()]


def test_altitude_policies(spark, bronze):
    assert altitudes(spark, bronze, "raw") == ["ground", "-75", "35000"]
    assert altitudes(spark, bronze, "int_or_null") == [None, -75, 35000]
    assert altitudes(spark, bronze, "zero_fill") == [0, -75, 35000]
    assert altitudes(spark, bronze, "int_or_null", "a2") == [1200, 1300]


def test_altitude_token_types(spark):
    doc = '{"a":1200.7,"b":"1200.7","c":true,"d":null,"f":"12d","g":1e3,"h":" 7 ","i":[1],"j":3000000000}'
    v = spark.createDataFrame([(doc,)], "j string").select(
        F.from_json("j", ",".join(f"{k} variant" for k in "abcdefghij")).alias("v")
    )
    got = v.select(
        *[numbers.token_int_or_null(F.col(f"v.{k}")).alias(f"{k}i") for k in "abcdefghij"],
        *[numbers.token_zero_fill(F.col(f"v.{k}")).alias(f"{k}z") for k in "abcdefghij"],
    ).first()
    assert [got[f"{k}i"] for k in "abcdefghij"] == [1200, None, 1, None, None, None, 1000, 7, None, None]
    assert [got[f"{k}z"] for k in "abcdefghij"] == [1200, 1200, 1, 0, 0, 0, 1000, 7, 0, 3000000000]


def test_iso_text(spark, bronze):
    pings = normalize(snapshots.flatten(by_bytes(spark, bronze)), "raw")
    seen = {r[0] for r in pings.select("timestamp").collect()}
    assert "2023-11-01T00:00:00.001000" in seen
    assert "2023-11-01T00:00:10" in seen


def test_latitude_fill(spark, bronze):
    flat = snapshots.flatten(by_bytes(spark, bronze)).where("icao = '~abc124'")
    assert normalize(flat, "zero_fill").first()["lat"] == 0.0
    assert normalize(flat, "int_or_null").first()["lat"] is None


def test_gold_conventions(spark, bronze):
    silver = normalize(snapshots.flatten(by_bytes(spark, bronze), keep=()), "zero_fill")
    gold = gold_pings(silver)
    assert gold.where("icao like '~abc12_'").count() == 2
    assert gold_pings(silver, truncate_icao=True).where("icao = '~abc12'").count() == 2
    a2 = gold.where("icao = 'a2'").first()
    assert (a2["registration"], a2["type"], a2["emergency"]) == ("", "", "")


def test_queries_on_fixture(spark, bronze):
    flat = snapshots.flatten(by_bytes(spark, bronze))
    typed = typed_table(flat)
    text = normalize(flat, "raw")
    assert rows(list_aircraft(typed, mode="distinct")) == [("a1", "N1", "GLF6")]
    assert rows(list_aircraft(text, mode="last_wins")) == [("a1", "N1", "GLF6")]
    lats = [r["lat"] for r in positions(typed, "a1").collect()]
    assert lats == [1.5, 1.6, 1.7]
    assert positions(typed, "a1", 2, 1).count() == 1
    assert positions(typed, "a1", 2, 9).count() == 0
    assert rows(stats(typed, "a1")) == [("a1", 35000, 450.1, True)]
    assert rows(stats(text, "a1", "lenient")) == [("a1", 35000.0, 450.1, True)]


def test_stats_flavours_differ(spark, bronze):
    flat = snapshots.flatten(by_bytes(spark, bronze)).where("icao = 'a1'")
    two = flat.where("timestamp < '2023-11-01 00:00:06'")
    one = flat.where("timestamp < '2023-11-01 00:00:04'")
    assert stats(normalize(two, "int_or_null"), "a1").first()["max_altitude_baro"] == -75
    assert stats(normalize(two, "raw"), "a1", "lenient").first()["max_altitude_baro"] == 0
    assert stats(normalize(one, "int_or_null"), "a1").first()["had_emergency"] is False
    assert stats(normalize(one, "raw"), "a1", "lenient").first()["had_emergency"] is True


def test_lenient_json(spark):
    texts = ['{"a": 1}', '{"a": 1,}', "{a: 1, b: [2,],}", "{a 1}", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(
        F.try_variant_get(snapshots.lenient_json("t"), "$.a", "int").alias("a")
    )
    assert [r[0] for r in got.collect()] == [1, 1, 1, None, None, None]


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [("2023-11-01",), ("2023-02-30",), ("20231101",), ("2023-11-01x",), (None,)], "d string"
    )
    assert [r[0] for r in df.select(times.day_to_source_date("d")).collect()] == [
        "20231101", None, None, None, None,
    ]
    floor = df.select(times.timestamp_or_floor("d")).collect()
    assert floor[3][0] == datetime(1677, 9, 21, 0, 12, 43, 145224)
    for bad in ("2023-02-30", "20231101", "2023-1-1", "x"):
        with pytest.raises(ValueError):
            times.day_argument(bad)


def test_file_names(spark):
    df = spark.createDataFrame(
        [("s3://b/x_v2/aircrafts_database_v12.json.gz",), ("a/aircrafts_database.json.gz",), ("a/12_aircraft_db.json.gz",)],
        "p string",
    )
    got = df.select(files.name_version("p"), files.leading_version("p")).collect()
    assert [tuple(r) for r in got] == [(12, None), (0, None), (0, 12)]
