"""Invariants of the question API, on the driver tables."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake import co2, list_aircraft, list_enriched, positions, stats
from aerolake.functions import flight
from aerolake.functions.text import canonical_text, clean_id_argument, strip_text
from tests.conftest import rows
from verification import views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pings(spark):
    return views.pings(spark, SF).cache()


@pytest.fixture(scope="module")
def registry(spark):
    return views.registry_history(spark, SF).cache()


def test_pages_tile_the_whole_list(pings):
    whole = list_aircraft(pings, 10_000, 0, "last_wins").collect()
    assert len({r["icao"] for r in whole}) == len(whole)
    pages = [list_aircraft(pings, 5, n, "last_wins").collect() for n in range(len(whole) // 5 + 2)]
    assert [r for p in pages for r in p] == whole
    assert all(len(p) <= 5 for p in pages) and pages[-1] == []
    assert [r["icao"] for r in whole] == sorted(r["icao"] for r in whole)


def test_page_guards(pings, registry):
    first = list_enriched(pings, registry, 5, 0).collect()
    assert list_enriched(pings, registry, 5, -1).collect() == first
    assert list_enriched(pings, registry, 5, 0).collect() == first
    assert list_enriched(pings, registry, 0, 0).count() == 0
    assert list_enriched(pings, registry, 5, 10_000).count() == 0
    assert all(r["icao"] for r in first)
    with pytest.raises(ValueError):
        list_aircraft(pings, -1, 0)
    with pytest.raises(ValueError):
        list_aircraft(pings, mode="other")
    with pytest.raises(ValueError):
        stats(pings, flavour="other")


def test_positions_ascend(pings):
    icao = pings.first()["icao"]
    times = [r["timestamp"] for r in positions(pings, icao).collect()]
    assert times and times == sorted(times)


def test_unknown_and_hostile_ids(pings):
    for icao in ("nope", "x'; DROP TABLE pings; --", "' OR '1'='1"):
        assert positions(pings, icao).count() == 0
        assert stats(pings, icao).count() == 0
        with pytest.raises(LookupError):
            positions(pings, icao, require_found=True)
        with pytest.raises(LookupError):
            stats(pings, icao, require_found=True)
    assert clean_id_argument("a'b;c--d") == "abcd"
    assert pings.count() > 0


def test_co2_is_not_negative_and_null_without_rate(spark, pings):
    result = co2(pings, views.fuel(spark))
    assert result.where("hours_flown <= 0 OR co2 < 0").count() == 0
    day = result.orderBy("icao", "day").first()
    one = co2(pings, views.fuel(spark), day["icao"], day["day"]).collect()
    assert [tuple(r) for r in one] == [tuple(day)]
    assert co2(pings, views.fuel(spark), day["icao"]).count() == result.where(
        F.col("icao") == day["icao"]
    ).count()


def test_hours_and_co2_values(spark):
    df = spark.createDataFrame(
        [(3, 503.0), (1, 503.0), (100, 503.0), (720, 503.0), (2, None), (5, 0.0)], "n long, g double"
    )
    hours = df.select(flight.hours_flown("n").alias("h"), "g")
    got = [tuple(r) for r in hours.select("h", flight.co2_tons("h", "g")).collect()]
    assert got == [
        (0.004167, 0.022125),
        (0.001389, 0.007375),
        (0.138889, 0.737436),
        (1.0, 5.309532),
        (0.002778, None),
        (0.006944, 0.0),
    ]


def test_rounding_equals_python_for_a_whole_day(spark):
    n = spark.range(1, 17281).select("id", flight.hours_flown("id").alias("h"))
    got = n.select("id", "h", flight.co2_tons("h", F.lit(503.0)).alias("c")).collect()
    for r in got:
        hours = round(r["id"] * 5 / 3600, 6)
        assert r["h"] == hours
        assert r["c"] == round(hours * 503.0 * 3.04 * 3.15 / 907.185, 6)


text_values = st.text(alphabet=list(" \t\n\r\x0b\xa0 \\tnr\"'ab"), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text_values, min_size=30, max_size=60))
def test_text_rules_equal_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.orderBy("i").select(strip_text("v"), canonical_text("v")).collect()
    for value, (stripped, canonical) in zip(values, got):
        assert stripped == value.strip()
        undone = value.strip()
        for written, meant in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\\\", "\\")):
            undone = undone.replace(written, meant)
        assert canonical == undone.strip("\"' \t\n\r")


def shown(value):
    """Numbers alike however they are typed or summed."""
    if isinstance(value, float):
        return f"{round(value, 5):g}"
    return str(value)


def test_registered_queries_match_their_sql(spark):
    import duckdb

    import __spark_entry__ as entry_module
    from verification.catalog import ORACLES, QUERIES

    connection = duckdb.connect()
    for name in "customer part orders events documents pages labels".split():
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, SF)
        found = connection.execute(sql)
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(got.columns), name
        expected = sorted(tuple(map(shown, r)) for r in found.fetchall())
        assert sorted(tuple(map(shown, r)) for r in got.select(*columns).collect()) == expected, name
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0
