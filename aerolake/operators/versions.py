"""File manifest and version rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.functions import files
from aerolake.sources.paths import DAY_COLUMN

KEEP_VERSIONS = 3


def scan_files(spark: SparkSession, root: str, *, name_glob: str | None = None) -> DataFrame:
    """Files with content under ``root``, with their day partition if any."""
    reader = spark.read.format("binaryFile").option("basePath", root).option("recursiveFileLookup", False)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    found = reader.load(root)
    day = F.col(DAY_COLUMN).cast("string") if DAY_COLUMN in found.columns else F.lit(None).cast("string")
    return found.select("path", "length", "modificationTime", "content", day.alias(DAY_COLUMN))


def manifest(files_df: DataFrame, *, source: Column | str | None = None) -> DataFrame:
    """One line per file: path, partition, size, version, hash, source, time."""
    origin = source if isinstance(source, Column) else F.lit(source).cast("string")
    return files_df.select(
        "path",
        DAY_COLUMN,
        F.col("length").alias("size"),
        files.name_version("path").alias("version"),
        files.content_hash("content").alias("file_hash"),
        origin.alias("source"),
        F.current_timestamp().alias("_loaded_time"),
    )


def latest_version(listing: DataFrame, partition: str = DAY_COLUMN) -> DataFrame:
    """Path with the highest version (as a number) of each partition."""
    best = F.max(F.struct("version", "path")).alias("best")
    return listing.groupBy(partition).agg(best).select(partition, "best.version", "best.path")


def next_version(
    listing: DataFrame, partitions: DataFrame | None = None, partition: str = DAY_COLUMN
) -> DataFrame:
    """Version the next file of each partition gets; 1 where there is none yet."""
    taken = listing.groupBy(partition).agg(F.max("version").alias("taken"))
    if partitions is not None:
        taken = partitions.select(partition).distinct().join(taken, partition, "left")
    return taken.select(partition, (F.coalesce("taken", F.lit(0)) + 1).alias("next_version"))


def superseded_versions(
    listing: DataFrame, keep: int = KEEP_VERSIONS, partition: str = DAY_COLUMN
) -> DataFrame:
    """Files beyond the newest ``keep`` of their partition.

    Ranking keeps only ``keep`` rows per partition (cut on each side of the
    shuffle); every file is then compared with its partition's cut-off, so a
    partition with very many files is never ranked in one task.
    """
    if keep <= 0:
        return listing
    newest_first = Window.partitionBy(partition).orderBy(F.desc("version"), F.desc("path"))
    newest = listing.select(partition, "version", "path", F.row_number().over(newest_first).alias("rank"))
    cutoff = (
        newest.where(F.col("rank") <= keep)
        .groupBy(F.col(partition).alias("cut_partition"))
        .agg(F.min(F.struct("version", "path")).alias("cutoff"))
    )
    same_partition = listing[partition].eqNullSafe(F.col("cut_partition"))
    older = F.struct("version", "path") < F.col("cutoff")
    return listing.join(cutoff, same_partition).where(older).select(*listing.columns)


def verify(manifest_df: DataFrame, expected: DataFrame, path: str = "path") -> DataFrame:
    """Expected files with ``found`` and ``intact`` (same hash)."""
    stored = manifest_df.select(path, F.col("file_hash").alias("stored_hash"))
    return expected.join(stored, path, "left").select(
        path,
        F.col("stored_hash").isNotNull().alias("found"),
        F.coalesce(F.col("stored_hash") == F.col("file_hash"), F.lit(False)).alias("intact"),
    )
