"""Prepared CSV, layered Parquet and relational tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schemas import PINGS_CSV, with_partition
from aerolake.sources.paths import DAY_COLUMN, day_glob, exists


def read_prepared_csv(
    spark: SparkSession, path: str, schema: T.StructType = PINGS_CSV, *, multi_line: bool = True
) -> DataFrame:
    """CSV with header, all text; a missing value reads as empty text.

    Texts may hold line ends; with ``multi_line`` off, files without such are split
    over tasks.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("multiLine", multi_line)
        .csv(path)
        .na.fill("")
    )


def read_layer(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    days: Iterable[str] | None = None,
    partition: str = DAY_COLUMN,
    *,
    with_file: bool = False,
) -> DataFrame:
    """Parquet of a partitioned layer; only the wanted day folders are listed.

    ``with_file`` adds the file each row came from as ``file_path``.
    """
    if partition not in schema.fieldNames():
        schema = with_partition(schema, partition)
    path = day_glob(root, days, partition)
    if exists(spark, path):
        rows = spark.read.schema(schema).option("basePath", root).parquet(path)
        file_path = F.col("_metadata.file_path")
    else:
        rows = spark.createDataFrame([], schema)
        file_path = F.lit(None).cast("string")
    return rows.select("*", file_path.alias("file_path")) if with_file else rows


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The values that `aerolake.sinks.write_tsv` was given."""
    fields = F.split("value", "\t", -1)
    lines = spark.read.option("lineSep", "\n").text(path).select(fields.alias("fields"))
    return lines.select(*[_tsv_value(F.col("fields")[i], f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def _tsv_value(written: Column, kind: T.DataType) -> Column:
    # an escaped backslash must not lend itself to the escape of what follows
    plain = F.array_join(
        F.transform(
            F.split(written, r"\\\\", -1),
            lambda part: F.replace(
                F.replace(F.replace(part, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")),
                F.lit("\\r"),
                F.lit("\r"),
            ),
        ),
        "\\",
    )
    if isinstance(kind, T.ArrayType):
        found = F.regexp_extract_all(plain, F.lit(r'(?s)"(?:[^"\\]|\\.)*"|NULL'), F.lit(0))
        value = F.transform(
            found,
            lambda x: F.when(
                x != "NULL",
                F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r"(?s)\\(.)", "$1"),
            ).cast(kind.elementType),
        )
    else:
        value = plain.cast(kind)
    return F.when(written != "\\N", value)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Gold table of a relational database; parallel when a split column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if (split_column is None) != (bounds is None):
        raise ValueError("split_column and bounds go together; without both, one task reads all")
    if split_column is not None:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Parquet folder; no column is read, only the file footers."""
    return spark.read.parquet(path).agg(F.count("*").alias("rows"))
