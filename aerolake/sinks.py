"""Writers. Each is one Spark job and can be run again without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.files import content_hash
from aerolake.schemas import PING_COLUMNS
from aerolake.sources.paths import DAY_COLUMN, layer_files, remove

WRITE_MODES = ("days", "refresh", "append")

# Hash slices per day; about 80 MB each for a full day of world traffic.
DAY_SLICES = 64

# Fixed value: how a missing value is written in tab-separated exports.
TSV_NULL = "\\N"


def write_prepared_csv(df: DataFrame, path: str, columns: list[str] = PING_COLUMNS) -> None:
    """CSV with header in fixed column order; the folder is replaced."""
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_layer(
    df: DataFrame,
    root: str,
    *,
    partition: str = DAY_COLUMN,
    sort_by: tuple[str, ...] = ("icao", "timestamp"),
    mode: str = "days",
    shuffle: bool = True,
    slices: int = DAY_SLICES,
    days: list[str] | None = None,
    all_days: bool = False,
) -> None:
    """Snappy Parquet by day, clustered and sorted by the first ``sort_by`` column.

    ``days`` mode replaces only the days present in ``df`` (which must hold them
    whole), ``refresh`` replaces everything, ``append`` adds files. A day named in
    ``days`` (any day, with ``all_days``) that ``df`` has no row of is emptied too;
    others keep what they had.

    With ``shuffle`` each day is cut into ``slices`` by hash of the first sort
    column, so one aircraft lies in few files and row-group statistics find it.
    REBALANCE then fits tasks to the data: small slices and days share a task, a
    slice made heavy by one aircraft is split. Pass False when the input already
    lies by day.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, got {mode!r}")
    if shuffle:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(sort_by[0]), F.lit(slices)))
        df = sliced.hint("rebalance", partition, "_slice").drop("_slice")
    writer = (
        df.sortWithinPartitions(partition, *sort_by)
        .write.partitionBy(partition)
        .option("compression", "snappy")
    )
    if mode == "append":
        writer.mode("append").parquet(root)
        return
    spark, wanted = df.sparkSession, None if all_days else days
    stale = mode == "days" and (all_days or days)
    before = layer_files(spark, root, wanted, partition) if stale else None
    overwrite = "dynamic" if mode == "days" else "static"
    writer.mode("overwrite").option("partitionOverwriteMode", overwrite).parquet(root)
    after = layer_files(spark, root, wanted, partition) if before is not None else None
    if after is not None:
        # files are replaced with the day; where one is still there, nothing was written now
        left = before.join(after.select("file_path"), "file_path", "left_semi").select(partition).distinct()
        for row in left.toLocalIterator():
            remove(spark, f"{root.rstrip('/')}/{partition}={row[0]}")


def write_refresh(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table folder."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def refresh_table(df: DataFrame, table: str, *, partition: str | None = None) -> None:
    """Replace a catalog table."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", "snappy")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(table)


def write_bucketed(
    df: DataFrame,
    table: str,
    *,
    partition: str,
    key: str = "icao",
    sort_by: tuple[str, ...] = ("timestamp",),
    buckets: int = DAY_SLICES,
) -> None:
    """Put days into a catalog table bucketed by ``key``; days present in ``df`` are
    replaced, others stay. The table is made if it is not there.

    Rows are dealt by the hash that Spark buckets by, so a bucket of a day is one file
    unless it is heavy; REBALANCE then splits it over tasks, each with a file of the
    bucket. Files are sorted by ``key`` and carry a Bloom filter on it.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != partition] + [partition]
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    dealt = df.select(*columns).withColumn("_bucket", bucket).hint("rebalance", partition, "_bucket")
    rows = dealt.sortWithinPartitions(partition, "_bucket", key, *sort_by).drop("_bucket")
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], rows.schema)
        (
            empty.write.format("parquet")
            .option("compression", "snappy")
            .option("partitionOverwriteMode", "dynamic")
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{key}", "20000")
            .partitionBy(partition)
            .bucketBy(buckets, key)
            .sortBy(key, *sort_by)
            .saveAsTable(table)
        )
    rows.write.insertInto(table, overwrite=True)


def write_versioned(df: DataFrame, root: str, day: str, version: int) -> str:
    """Write one version of a day's table and return its folder."""
    path = f"{root.rstrip('/')}/{DAY_COLUMN}={day}/version={version}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_tsv(df: DataFrame, path: str) -> None:
    r"""Tab-separated text without header for bulk loads; `read_tsv` undoes it.

    Null is ``\N``; backslashes are doubled and tabs and line ends written as
    escapes, so each row is a line; arrays are ``{"a","b",NULL}``.
    """
    columns = [F.coalesce(_tsv_column(f), F.lit(TSV_NULL)) for f in df.schema.fields]
    df.select(F.concat_ws("\t", *columns).alias("value")).write.mode("overwrite").text(path)


def archive_bytes(files_df: DataFrame, root: str, mode: str = "days") -> None:
    """Keep raw files unchanged, with size and hash, by day.

    Contents are not shuffled: every task writes what it read.
    """
    rows = files_df.select(
        "path", "length", content_hash("content").alias("sha256"), "content", DAY_COLUMN
    )
    write_layer(rows, root, sort_by=(), mode=mode, shuffle=False)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batch_size: int = 10_000,
    partitions: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Empty a relational table and load it in batches.

    ``partitions`` bounds the connections opened at a time.
    """
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .option("batchsize", batch_size)
        .option("numPartitions", partitions)
    )
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()


def _tsv_column(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.ArrayType):
        quoted = F.transform(
            c.cast("array<string>"),
            lambda x: F.coalesce(
                F.concat(
                    F.lit('"'),
                    F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                    F.lit('"'),
                ),
                F.lit("NULL"),
            ),
        )
        c = F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))
    elif isinstance(field.dataType, T.TimestampType):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    c = c.cast("string")
    for raw, escape in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(escape))
    return c
