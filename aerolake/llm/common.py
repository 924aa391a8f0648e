"""Helpers shared by the operators: inputs, scratch tables, Arrow mapping."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII white space.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def tune(spark: SparkSession) -> SparkSession:
    """Bound what one Arrow batch may hold (texts can be very long), and let workers
    import the package from where the driver has it, if that folder is there too."""
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16777216")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor reaches.

    It lies under spark.checkpoint.dir; only where that is unset (tests) under
    the warehouse folder, which every session has.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark takes it to be in."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()
    return "file://" + whole[5:] if whole.startswith("file:/") and not whole.startswith("file://") else whole


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the frame and read it again: what follows no longer depends on the
    executors that made it, and is not computed twice. The shuffles that led to it go
    as soon as it is written, so the disk holds those of one step at a time."""
    spark = df.sparkSession
    path = scratch(spark, label)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key that holds more than one in so many rows is hot.
HOT = 1_000


def looked_up(rows: DataFrame, facts: DataFrame, key: str, weight: str, salt: list[str]) -> DataFrame:
    """All rows with the columns of ``facts``, null where none has the row's key.

    ``facts`` has a text key once and in ``weight`` how many rows have it. The hot keys,
    less than ``HOT``, are broadcast; rows that have none of the others are spread by
    the ``salt`` columns, so no task of the shuffle gets a hot key or all the nulls.
    """
    total = facts.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    names = [c for c in facts.columns if c != key]
    hot = F.col(weight) * HOT > F.lit(total)

    def part(kind, at: str, name: str) -> DataFrame:
        return facts.where(kind).select(F.col(key).alias(at), F.struct(*names).alias(name))

    with_hot = rows.join(F.broadcast(part(hot, "_key", "_hot")), F.col(key) == F.col("_key"), "left").drop("_key")
    elsewhere = F.concat(F.lit("\0"), F.xxhash64(*salt).cast("string"))
    spread = F.coalesce(F.when(F.col("_hot").isNull(), F.col(key)), elsewhere)
    both = with_hot.withColumn("_at", spread).join(part(~hot, "_at", "_cold"), "_at", "left")
    found = both.withColumn("_found", F.coalesce("_hot", "_cold"))
    return found.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in names])


def shards_for(rows: int, each: int) -> int:
    return max(1, math.ceil(rows / each))


def map_arrow(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]], schema: str
) -> DataFrame:
    """mapInArrow with a function per task: ``make`` sets it up, then each batch
    gives dicts of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)
