import gzip
import json
import os
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

# Collected timestamps are shown in the zone of the Python process.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aerolake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("aerolake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


SNAPSHOT_FILES = {
    "000000Z.json": b'{"now":1698796800.001,"aircraft":['
    b'{"hex":"a1","r":"N1","t":"GLF6","lat":1.5,"lon":2.5,"alt_baro":"ground","gs":3.2,"emergency":"none"},'
    b'{"hex":"a2","alt_baro":1200.7,"gs":100.5},'
    b'{"hex":"~abc123","r":"","t":"C172","alt_baro":-75}]}',
    "000005Z.json": b'{"now":1698796805.001,"aircraft":['
    b'{"hex":"a1","r":"N1","t":"GLF6","lat":1.6,"lon":2.6,"alt_baro":-75,"gs":"bad","emergency":"general"},'
    b'{"hex":"~abc124","t":"C172","lat":"bad"}]}',
    "000010Z.json.gz": gzip.compress(
        b'{"now":1698796810,"aircraft":['
        b'{"hex":"a1","r":"N1","t":"GLF6","lat":1.7,"lon":2.7,"alt_baro":35000,"gs":450.1}]}'
    ),
    "000015Z.json": b'{"now": 1, "aircraft": [',
    "000020Z.json": b'{"now":1698796820}',
    "000025Z.json": gzip.compress(
        b'{"now":1698796825,"aircraft":[{"hex":"a2","alt_baro":"1300"}]}'
    ),
}


@pytest.fixture(params=["_in_date"])
def bronze(request, tmp_path):
    return write_snapshots(tmp_path / "bronze", request.param, SNAPSHOT_FILES)


@pytest.fixture
def raw(tmp_path):
    return write_snapshots(tmp_path / "raw", "day", SNAPSHOT_FILES)


def write_snapshots(root, partition, files, day="20231101"):
    folder = root / f"{partition}={day}"
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return str(root)


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    path.write_bytes(gzip.compress("\n".join(lines).encode()))
    return str(path)


def rows(df, *order):
    """Rows as plain tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(map(_key, t)))


def _key(v):
    return (v is not None, str(v))
