"""Time the headline queries and the preparation of 1,000 snapshot files.

Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import gzip
import json
import os
import statistics
import sys
import time
import uuid
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from aerolake import sinks  # noqa: E402
from aerolake.operators import emissions, fleet  # noqa: E402
from aerolake.plans import pings, prepare  # noqa: E402
from aerolake.schemas import PINGS_TYPED  # noqa: E402
from aerolake.session import configure, scratch_path  # noqa: E402
from aerolake.sources import tables  # noqa: E402
from aerolake.sources.paths import layer_files  # noqa: E402
from verification import views  # noqa: E402
from verification.catalog import QUERIES  # noqa: E402

SNAPSHOT_FILES = 1000
# One document every five seconds.
DAY_FILES = 17_280

HEADLINE = """
co2_by_type co2_fleet_day co2_one_aircraft_day
list_last_wins list_distinct list_distinct_page positions_page
stats_sql stats_lenient stats_one_aircraft list_enriched list_enriched_page
flatten_snapshots normalize_zero gzip_fallback file_outcomes lenient_json dynamic_key_object
trim_text text_canonical clean_id year_and_flags day_check index_links run_dates
change_detection close_rows scd2_merge registry_history_job
file_hash version_latest version_retain manifest_verify
load_stats_pings load_stats_registry
silver_roundtrip csv_roundtrip tsv_roundtrip day_overwrite pings_job jsonl_registry
""".split()


def landed_snapshots(sf_dir: str, root: Path) -> str:
    """The events as SNAPSHOT_FILES compressed snapshot files of one day."""
    events = pq.read_table(f"{sf_dir}/events.parquet").to_pylist()
    per_file = -(-len(events) // SNAPSHOT_FILES)
    for partition in ("day", "_in_date"):
        (root / partition / f"{partition}=20240101").mkdir(parents=True)
    for number in range(SNAPSHOT_FILES):
        some = events[number * per_file : (number + 1) * per_file]
        document = {
            "now": 1704067200 + 5 * number,
            "aircraft": [
                {
                    "hex": f"{e['user_id']:06x}",
                    "r": f"N{e['user_id']}",
                    "t": e["event_type"],
                    "lat": e["value"],
                    "lon": e["value"],
                    "alt_baro": "ground" if e["event_type"] == "error" else e["user_id"],
                    "gs": e["value"],
                    "emergency": "none",
                }
                for e in some
            ],
        }
        data = gzip.compress(json.dumps(document).encode(), 1)
        for partition in ("day", "_in_date"):
            (root / partition / f"{partition}=20240101" / f"{number:06d}Z.json.gz").write_bytes(data)
    return str(root)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("aerolake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = landed_snapshots(sf_dir, Path(urlparse(scratch_path(spark, "bench")).path))

    def registered(name, folder=sf_dir):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    # Warm-up on a small copy of the tables where there is one, so that the
    # times are those of a running session rather than of compiling its code.
    small = Path(sf_dir).parent / "sf0.001"
    for name in HEADLINE:
        registered(name, str(small) if small.is_dir() else sf_dir)
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        timed(name, lambda name=name: registered(name))
    timed(
        "prepare_1000_files_csv",
        lambda: prepare.prepare_csv(spark, f"{root}/day", f"{root}/csv", "2024-01-01"),
    )
    timed(
        "prepare_1000_files_silver_gold",
        lambda: pings.run_pings(
            spark, f"{root}/_in_date", f"{root}/silver", f"{root}/gold", ["2024-01-01"]
        ),
    )
    # one aircraft from the gold layer, sorted by id, and list pages called again and again
    gold = f"{root}/events-gold"
    sinks.write_layer(views.pings(spark, sf_dir), gold, partition="source_date")
    seen = tables.read_layer(spark, gold, PINGS_TYPED, partition="source_date")
    timed("stats_one_aircraft_gold", lambda: fleet.stats(seen, "000008").collect())
    timed(
        "co2_one_aircraft_day_gold",
        lambda: emissions.co2(seen, views.fuel(spark), "000008", "2024-01-01").collect(),
    )
    # the same from a table bucketed by aircraft
    name = f"bench_pings_{uuid.uuid4().hex}"
    sinks.write_bucketed(views.pings(spark, sf_dir), name, partition="source_date", buckets=8)
    bucketed = spark.table(name)
    timed("stats_one_aircraft_bucketed_table", lambda: fleet.stats(bucketed, "000008").collect())
    # every file of a full day in the index, none of them read
    full = Path(root) / "full" / "_in_date=20240101"
    full.mkdir(parents=True)
    for number in range(DAY_FILES):
        (full / f"{number:06d}Z.json").write_bytes(b"{}")
    timed("list_full_day_17280_files", lambda: layer_files(spark, str(full.parent), ["20240101"]).count())
    spread = {}
    for name in ("list_distinct_page", "list_enriched_page"):
        calls = []
        for _ in range(5):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).collect()
            calls.append(time.perf_counter() - start)
        seconds[f"{name}_5_calls"] = round(sum(calls), 3)
        spread[name] = round(statistics.pstdev(calls), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "snapshot_files": SNAPSHOT_FILES,
                "spread_of_5_calls": spread,
            }
        )
    )


if __name__ == "__main__":
    main()
