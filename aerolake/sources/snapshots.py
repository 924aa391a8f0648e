"""Snapshot documents: one JSON object ``{now, aircraft: [...]}`` per file.

Every reader here returns one row per *document*: ``now``, ``aircraft``,
``_corrupt_record``, ``file_path`` and the day partition. Nothing is dropped at
this stage, so good and bad files can both be counted; `flatten` keeps only
the usable ones.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions import files, numbers, times
from aerolake.schemas import CORRUPT, SNAPSHOT_DOC, with_partition
from aerolake.sources.paths import DAY_COLUMN, day_glob, exists, listed, path_day, plain_path


def scan_snapshots(
    spark: SparkSession,
    root: str,
    days: Iterable[str] | None = None,
    *,
    name_glob: str | None = None,
    partition: str = DAY_COLUMN,
    with_empty: bool = True,
) -> DataFrame:
    """Read plain ``.json`` and compressed ``.gz`` files, inflated by Spark by name.

    ``days`` (``YYYYMMDD``) restricts the listing to those folders; days without
    files give no rows. What counts as a document is the same as in
    `scan_snapshot_bytes`. Files without any byte are unreadable documents; who only
    wants pings leaves them out.
    """
    reader = spark.read.option("wholetext", True).format("text")
    return _scan(spark, root, days, name_glob, partition, reader, with_empty)


def scan_snapshot_bytes(
    spark: SparkSession,
    root: str,
    days: Iterable[str] | None = None,
    *,
    name_glob: str | None = None,
    partition: str = DAY_COLUMN,
    with_empty: bool = True,
) -> DataFrame:
    """Read files whose payload may be JSON or gzip, whatever they are called."""
    return _scan(spark, root, days, name_glob, partition, spark.read.format("binaryFile"), with_empty)


def _scan(spark, root, days, name_glob, partition, reader, with_empty) -> DataFrame:
    """Documents of all files. Those without any byte, which the readers pass over,
    are what the file index has and a look at names and sizes does not give."""
    days = None if days is None else list(days)
    path = day_glob(root, days, partition)
    if not exists(spark, path):
        return _no_documents(spark, with_partition(SNAPSHOT_DOC, partition))
    reader = reader.option("basePath", root)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    raw = reader.load(path)
    day = F.col(partition).cast("string") if partition in raw.columns else F.lit(None).cast("string")
    text = payload_text("content") if "content" in raw.columns else F.make_valid_utf8("value")
    texts = raw.select(text.alias("text"), day.alias(partition), F.col("_metadata.file_path").alias("file_path"))
    if with_empty:
        sized = spark.read.format("binaryFile").option("basePath", root)
        if name_glob:
            sized = sized.option("pathGlobFilter", name_glob)
        filled = sized.load(path).select(plain_path(F.col("_metadata.file_path")).alias("file_path"))
        empty = listed(raw).join(filled, "file_path", "left_anti").where(path_day("file_path", partition).isNotNull())
        texts = texts.unionByName(
            empty.select(F.lit("").alias("text"), path_day("file_path", partition).alias(partition), "file_path")
        )
    return parse_documents(texts, "text")


def scan_archive(spark: SparkSession, root: str, days: Iterable[str] | None = None) -> DataFrame:
    """Documents of snapshot files kept by `aerolake.sinks.archive_bytes`: a few
    Parquet files a day instead of thousands of small ones."""
    path = day_glob(root, days)
    if not exists(spark, path):
        return _no_documents(spark, with_partition(SNAPSHOT_DOC, DAY_COLUMN))
    kept = spark.read.option("basePath", root).parquet(path)
    texts = kept.select(
        payload_text("content").alias("text"),
        F.col(DAY_COLUMN).cast("string").alias(DAY_COLUMN),
        F.col("path").alias("file_path"),
    )
    return parse_documents(texts, "text")


def payload_text(content: Column | str) -> Column:
    """Bytes to text: gunzip where the magic number says so, then UTF-8.

    Bytes that are no UTF-8 are replaced, not refused. Only gzip payloads cross
    into Python; plain ones pass as null there.
    """
    content = F.col(content) if isinstance(content, str) else content
    zipped = files.is_gzip(content)
    inflated = gunzip(F.when(zipped, content))
    plain = F.when(zipped, inflated).otherwise(content)
    return F.make_valid_utf8(plain.cast("string"))


def _gunzip_udf():
    # Nested, so that it travels by value and executors need not have the package.
    def inflate(data: bytes) -> bytes | None:
        import zlib

        parts = []
        try:
            while data:
                member = zlib.decompressobj(wbits=31)
                parts.append(member.decompress(data) + member.flush())
                if not member.eof:
                    return None
                data = member.unused_data.lstrip(b"\0")
        except zlib.error:
            return None
        return b"".join(parts)

    def gunzip(content: pd.Series) -> pd.Series:
        return content.map(inflate, na_action="ignore")

    return F.pandas_udf(gunzip, T.BinaryType())


gunzip = _gunzip_udf()  # gzip payload to bytes; a damaged one gives null


def one_json_value(c: Column) -> Column:
    """Whether a text holds exactly one JSON value and nothing after it."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1, F.lit(False))


def parse_documents(df: DataFrame, text: str) -> DataFrame:
    """Parse a column of snapshot documents; unreadable text is marked corrupt.

    A document is one JSON object: lists, several documents, text after the
    object and a byte-order mark before it are refused. The text is parsed once, as the
    only entry of a list with a mark behind it: what ends the list early loses the mark.
    """
    rest = [c for c in df.columns if c != text]
    listed_text = F.concat(F.lit('{"docs":['), F.col(text), F.lit('],"whole":"."}'))
    checked = df.select(F.when(F.ltrim(F.col(text)).startswith("{"), listed_text).alias("boxed"), *rest)
    parsed = F.from_json("boxed", _BOX, {"columnNameOfCorruptRecord": CORRUPT})
    boxes = checked.select(parsed.alias("box"), *rest)
    good = F.col("box.whole").isNotNull() & (F.size("box.docs") == 1) & F.col(f"box.{CORRUPT}").isNull()
    return boxes.select(
        F.get("box.docs", F.lit(0)).getField("now").alias("now"),
        F.get("box.docs", F.lit(0)).getField("aircraft").alias("aircraft"),
        F.when(~F.coalesce(good, F.lit(False)), F.coalesce(f"box.{CORRUPT}", F.lit(""))).alias(CORRUPT),
        *rest,
    )


_BOX = T.StructType(
    [
        T.StructField("docs", T.ArrayType(T.StructType([f for f in SNAPSHOT_DOC.fields if f.name != CORRUPT]))),
        T.StructField("whole", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)


def lenient_json(c: Column | str) -> Column:
    """Parse JSON text; if that fails, repair commas and bare keys and retry.

    Text after the value is refused; of a repeated key the last value stays.
    """
    c = F.col(c) if isinstance(c, str) else c
    repaired = c
    for pattern, replacement in JSON_REPAIRS:
        repaired = F.regexp_replace(repaired, pattern, replacement)
    return F.coalesce(
        F.when(one_json_value(c), F.try_parse_json(c)),
        F.when(one_json_value(repaired), F.try_parse_json(repaired)),
    )


# A comma before a closing bracket, and a property name
# without quotes, each with what it is replaced by.
JSON_REPAIRS = [
    (r",(\s*[}\]])", r"$1"),
    (r"([{,]\s*)(\w+)(\s*:)", r'$1"$2"$3'),
]


def snapshot_time(docs_now: Column | str = "now") -> Column:
    """Time of a document: absent means epoch 0, a non-number gives null."""
    now = F.col(docs_now) if isinstance(docs_now, str) else docs_now
    seconds = F.when(now.isNull(), F.lit(0.0)).otherwise(numbers.token_number(now))
    return times.epoch_to_timestamp(seconds)


def is_usable() -> Column:
    """A document that parses, has a usable time and no null aircraft entry."""
    no_null_entry = ~F.coalesce(F.exists("aircraft", lambda a: a.isNull()), F.lit(False))
    return F.col(CORRUPT).isNull() & snapshot_time().isNotNull() & no_null_entry


def flatten(docs: DataFrame, keep: Iterable[str] = ("file_path", DAY_COLUMN)) -> DataFrame:
    """One row per aircraft entry of every usable document.

    Leaves stay as found (``alt_baro`` is still a JSON token); `normalize` in
    `aerolake.operators.normalize` types them.
    """
    carried = [c for c in keep if c in docs.columns]
    entries = F.when(is_usable(), F.col("aircraft")).alias("entries")
    usable = docs.select(entries, snapshot_time().alias("timestamp"), *carried)
    # Outer explode plus a filter on its output: a filter on the documents would
    # be pushed below the parsing and make it run twice.
    rows = usable.select(F.explode_outer("entries").alias("a"), "timestamp", *carried).where(
        F.col("a").isNotNull()
    )
    return rows.select(
        F.col("a.hex").alias("icao"),
        F.col("a.r").alias("registration"),
        F.col("a.t").alias("type"),
        F.col("a.lat").alias("lat"),
        F.col("a.lon").alias("lon"),
        F.col("a.alt_baro").alias("alt_baro"),
        "timestamp",
        F.col("a.gs").alias("ground_speed"),
        F.col("a.emergency").alias("emergency"),
        *carried,
    )


def _no_documents(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(
        [], T.StructType(schema.fields + [T.StructField("file_path", T.StringType())])
    )
