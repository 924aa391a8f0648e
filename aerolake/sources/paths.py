"""Folders of a layered store."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_COLUMN = "_in_date"


def day_glob(root: str, days: Iterable[str] | None, partition: str = DAY_COLUMN) -> str:
    """Path of the wanted day folders, so that no other folder is listed."""
    root = root.rstrip("/")
    if days is None:
        return root
    return f"{root}/{partition}={{{','.join(sorted(set(days)))}}}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path or glob matches anything.

    Days without files are normal, and reading a missing path is an error.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def entries(spark: SparkSession, pattern: str) -> list[tuple[str, int, bool]]:
    """(path, length, is a folder) of all that matches the glob."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(hadoop_path)
    return [(str(f.getPath()), f.getLen(), f.isDirectory()) for f in found or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a layer with all it holds."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its name; raises if the file system refuses."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    store = hadoop_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.rename(hadoop_path(source), hadoop_path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def starts_as_gzip(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with the gzip magic number."""
    stream = _open(spark, path)
    try:
        return (stream.read(), stream.read()) == (0x1F, 0x8B)
    finally:
        stream.close()


def copy_stream(spark: SparkSession, source: str, target: str) -> str:
    """Copy a file of any size, a buffer at a time in the JVM; SHA-256 of what was read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path)
    return _drain(spark, source, out)


def stream_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file, read as a stream."""
    return _drain(spark, path, spark._jvm.java.io.OutputStream.nullOutputStream())


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)


def _drain(spark: SparkSession, path: str, out) -> str:
    jvm = spark._jvm
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    stream = jvm.java.security.DigestInputStream(_open(spark, path), digest)
    # closes both, so a copy that could not be finished raises
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, True)
    return bytes(digest.digest()).hex()


def listed(df: DataFrame) -> DataFrame:
    """``file_path`` of all files that a frame read from files found, also those without
    any byte. The list is the one that Spark's file index made (as a job where there are
    many folders); it stays in the JVM and never passes through Python."""
    spark = df.sparkSession
    jvm = spark._jvm
    found = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(df._jdf.inputFiles())
    names = spark._jsparkSession.createDataset(found, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(names.toDF(), spark).select(plain_path("value").alias("file_path"))


def plain_path(path: Column | str) -> Column:
    """File path as readers show it: without an empty authority."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def layer_files(
    spark: SparkSession, root: str, days: Iterable[str] | None, partition: str = DAY_COLUMN, name_glob: str | None = None
) -> DataFrame | None:
    """``file_path`` and day of the files in the wanted day folders as they are now; None
    if there is no such folder. Files outside any day folder are left out."""
    top = day_glob(root, days, partition)
    if not exists(spark, top):
        return None
    reader = spark.read.format("binaryFile").option("basePath", root)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return listed(reader.load(top)).select("file_path", path_day("file_path", partition).alias(partition)).where(
        F.col(partition).isNotNull()
    )


def path_day(path: str, partition: str = DAY_COLUMN) -> Column:
    """Day of the folder that a file lies in, null if it lies in none."""
    found = F.regexp_extract(path, f"/{re.escape(partition)}=([^/]*)/", 1)
    return F.when(found != "", found)
