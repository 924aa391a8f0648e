"""Registry: versioned bronze files to versioned silver to the gold history.

Gold keeps closed rows where the load that closed them put them and rewrites
only the current ones:

    gold/rows/_load=<version>/is_current=<true|false>/…
    gold/loads/…                       one line per finished load

A load is visible once its line is in ``loads``. What an interrupted load left
behind has a higher version than any line and is replaced by the next try.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake import sinks
from aerolake.functions.files import name_version
from aerolake.functions.times import day_argument, utc
from aerolake.operators import history, versions
from aerolake.operators.lineage import lineage_values
from aerolake.schemas import REGISTRY, REGISTRY_GOLD, struct
from aerolake.session import require
from aerolake.sources import registry
from aerolake.sources.paths import (
    DAY_COLUMN,
    copy_stream,
    entries,
    exists,
    remove,
    rename,
    starts_as_gzip,
    stream_hash,
)

# Fixed value: how landed registry files are named.
FILE_PREFIX = "aircrafts_database"

LOADS = struct(
    "version int, loaded_at timestamp, source_date string, opened bigint, closed bigint"
)


MANIFEST = struct(
    f"path string, {DAY_COLUMN} string, version int, size bigint, file_hash string, source string,"
    " _loaded_time timestamp"
)


@dataclass(frozen=True)
class LoadReport:
    """``duplicates``: rows passed over because their key had another one."""

    version: int | None
    opened: int
    closed: int
    duplicates: int = 0


def bronze_listing(spark: SparkSession, bronze_root: str, day: str) -> DataFrame:
    """Landed registry files of a day with their versions (names only)."""
    folder = f"{bronze_root.rstrip('/')}/{DAY_COLUMN}={day_argument(day)}"
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"{FILE_PREFIX}*").load(folder)
    return found.select("path", name_version("path").alias("version")).withColumn(
        DAY_COLUMN, F.lit(day_argument(day))
    )


def silver_listing(spark: SparkSession, silver_root: str, day: str) -> DataFrame:
    """Written silver versions of a day; none when the day is not there yet."""
    folder = f"{silver_root.rstrip('/')}/{DAY_COLUMN}={day_argument(day)}"
    # from the folder names: a version without rows is a version too
    names = [path.rsplit("=", 1)[1] for path, _, is_folder in entries(spark, f"{folder}/version=*") if is_folder]
    found = spark.createDataFrame([(int(n),) for n in names if n.isdigit()], struct("version int"))
    return found.withColumn(DAY_COLUMN, F.lit(day_argument(day)))


def to_silver(spark: SparkSession, bronze_root: str, silver_root: str, day: str) -> str:
    """Newest bronze file of the day to the next silver version; its folder."""
    newest = versions.latest_version(bronze_listing(spark, bronze_root, day)).first()
    if newest is None:
        raise FileNotFoundError(f"no registry file landed for {day}")
    records = registry.registry_records(registry.scan_registry_lines(spark, newest["path"]))
    wanted = spark.range(1).select(F.lit(day_argument(day)).alias(DAY_COLUMN))
    following = versions.next_version(silver_listing(spark, silver_root, day), wanted)
    version = following.first()["next_version"]
    return sinks.write_versioned(records, silver_root, day_argument(day), version)


def land(
    spark: SparkSession, source: str, bronze_root: str, day: str, loaded_at: datetime | None = None
) -> str:
    """Keep a delivered file (or the files of a folder) unchanged as the day's next
    bronze version.

    Bytes are copied as a stream between the file systems, hashed on the way, and the
    copy's hash is taken from the copy, so a file may be of any size. Only its name tells
    whether it is gzip afterwards, as the line reader goes by it. The version is visible
    when all its files are there, and recorded under ``bronze_root/_manifest``. Returns
    the version's folder.
    """
    require(spark)
    written = day_argument(day)
    given = [(path, size) for path, size, is_folder in entries(spark, source) if not is_folder]
    if not given:
        given = [
            (path, size)
            for path, size, is_folder in entries(spark, f"{source.rstrip('/')}/*")
            if not is_folder and not path.rsplit("/", 1)[1].startswith(("_", "."))
        ]
    if not given:
        raise FileNotFoundError(f"nothing was delivered at {source}")
    wanted = spark.range(1).select(F.lit(written).alias(DAY_COLUMN))
    number = versions.next_version(landed(spark, bronze_root, day), wanted).first()["next_version"]
    top = f"{bronze_root.rstrip('/')}/{DAY_COLUMN}={written}"
    folder, beside = f"{top}/{FILE_PREFIX}_v{number}.jsonl", f"{top}/_landing-{uuid.uuid4().hex}"
    at, rows = utc(loaded_at or datetime.now(timezone.utc)), []
    for path, size in given:
        name = path.rsplit("/", 1)[1].removesuffix(".gz") + (".gz" if starts_as_gzip(spark, path) else "")
        digest = copy_stream(spark, path, f"{beside}/{name}")
        if digest != stream_hash(spark, f"{beside}/{name}"):
            raise OSError(f"the copy in {beside} differs from {path}")
        rows.append((f"{folder}/{name}", written, number, size, digest, path, at))
    rename(spark, beside, folder)
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
        f"{bronze_root.rstrip('/')}/_manifest"
    )
    return folder


def landed(spark: SparkSession, bronze_root: str, day: str) -> DataFrame:
    """path, version and day of what was landed for a day."""
    top = f"{bronze_root.rstrip('/')}/{DAY_COLUMN}={day_argument(day)}"
    names = [path for path, _, is_folder in entries(spark, f"{top}/{FILE_PREFIX}_v*") if is_folder]
    found = spark.createDataFrame([(p,) for p in names], struct("path string"))
    return found.select("path", name_version("path").alias("version")).withColumn(
        DAY_COLUMN, F.lit(day_argument(day))
    )


def superseded(spark: SparkSession, bronze_root: str, day: str) -> DataFrame:
    """Landed versions of a day beyond the newest ones that are kept."""
    return versions.superseded_versions(landed(spark, bronze_root, day))


def landed_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, day: str) -> str:
    """Newest landed version of the day to the next silver version; its folder."""
    newest = versions.latest_version(landed(spark, bronze_root, day)).first()
    if newest is None:
        raise FileNotFoundError(f"no registry was landed for {day}")
    # read by lines: a plain file is divided over tasks, a gzip one is inflated as a stream
    records = registry.registry_records(registry.scan_registry_lines(spark, newest["path"]))
    wanted = spark.range(1).select(F.lit(day_argument(day)).alias(DAY_COLUMN))
    following = versions.next_version(silver_listing(spark, silver_root, day), wanted)
    return sinks.write_versioned(records, silver_root, day_argument(day), following.first()["next_version"])


def newest_silver(spark: SparkSession, silver_root: str, day: str) -> str:
    version = silver_listing(spark, silver_root, day).agg(F.max("version")).first()[0]
    if version is None:
        raise FileNotFoundError(f"no silver registry for {day}")
    return f"{silver_root.rstrip('/')}/{DAY_COLUMN}={day_argument(day)}/version={version}"


def read_loads(spark: SparkSession, gold_root: str) -> DataFrame:
    path = f"{gold_root.rstrip('/')}/loads"
    if not exists(spark, path):
        return spark.createDataFrame([], LOADS)
    return spark.read.schema(LOADS).parquet(path)


def _last_version(spark: SparkSession, gold_root: str) -> int:
    return read_loads(spark, gold_root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_history(spark: SparkSession, gold_root: str) -> DataFrame:
    """All registry rows, closed and current, as of the last finished load."""
    return _history_at(spark, gold_root, _last_version(spark, gold_root))


def _history_at(spark: SparkSession, gold_root: str, last: int) -> DataFrame:
    if last == 0:
        return spark.createDataFrame([], REGISTRY_GOLD)
    schema = T.StructType(REGISTRY_GOLD.fields + [T.StructField("_load", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(f"{gold_root.rstrip('/')}/rows")
    current = F.col("is_current") & (F.col("_load") == last)
    closed = ~F.col("is_current") & (F.col("_load") <= last)
    return rows.where(current | closed).select(*REGISTRY_GOLD.fieldNames())


def to_gold(
    spark: SparkSession,
    silver_path: str,
    gold_root: str,
    day: str,
    loaded_at: datetime | None = None,
    *,
    refuse_duplicates: bool = False,
    keep: int = 2,
) -> LoadReport:
    """Merge one silver version into the history.

    One join decides and is written; what it opened and closed is counted in the
    written rows. A load without changes has no version: its rows are taken back, and no
    line makes them visible. Of rows with the same key the smallest counts, unless
    ``refuse_duplicates`` raises. Current rows of all but the last ``keep`` loads
    are removed, so readers that began before this load still find theirs.
    """
    require(spark)
    loaded_at = utc(loaded_at or datetime.now(timezone.utc))
    last = _last_version(spark, gold_root)
    version = last + 1
    silver = spark.read.schema(REGISTRY).parquet(silver_path)
    current = history.current_only(_history_at(spark, gold_root, last))
    incoming = registry.clean_registry(silver)
    merged = history.merge_current(
        current,
        incoming,
        loaded_at=loaded_at,
        source_date=day_argument(day),
        version=version,
        lineage=lineage_values(F.lit(silver_path)),
        copies="_copies",
    )
    folder = f"{gold_root.rstrip('/')}/rows/_load={version}"
    merged.write.mode("overwrite").partitionBy("is_current").parquet(folder)
    found = spark.read.schema(merged.schema).parquet(folder).agg(
        F.count_if(F.col("is_current") & (F.col("version") == version)).alias("opened"),
        F.count_if(~F.col("is_current")).alias("closed"),
        F.coalesce(F.sum("_copies") - F.count("_copies"), F.lit(0)).alias("duplicates"),
    ).first()
    opened, closed, duplicates = found["opened"], found["closed"], found["duplicates"]
    if opened == 0 or (duplicates and refuse_duplicates):
        remove(spark, folder)
    if duplicates and refuse_duplicates:
        raise ValueError(f"{duplicates} rows of {silver_path} repeat a key")
    if opened == 0:
        return LoadReport(None, 0, 0, duplicates)
    line = [(version, loaded_at, day_argument(day), opened, closed)]
    spark.createDataFrame(line, LOADS).coalesce(1).write.mode("append").parquet(
        f"{gold_root.rstrip('/')}/loads"
    )
    drop_old_current(spark, gold_root, version - keep)
    return LoadReport(version, opened, closed, duplicates)


def drop_old_current(spark: SparkSession, gold_root: str, last: int) -> None:
    """Remove the copies of current rows that loads up to ``last`` wrote; closed
    rows stay where they are."""
    for path, _, _ in entries(spark, f"{gold_root.rstrip('/')}/rows/_load=*/is_current=true"):
        if int(path.split("/_load=", 1)[1].split("/", 1)[0]) <= last:
            remove(spark, path)


def run_registry(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    day: str,
    loaded_at: datetime | None = None,
) -> LoadReport:
    """Newest landed file of a day through silver into the history."""
    silver_path = to_silver(spark, bronze_root, silver_root, day)
    return to_gold(spark, silver_path, gold_root, day, loaded_at)
