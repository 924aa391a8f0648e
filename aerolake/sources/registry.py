"""Aircraft registry: JSON Lines, plain or gzip by file name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions import numbers, text
from aerolake.schemas import CORRUPT, REGISTRY, REGISTRY_LINE

TEXT_FIELDS = ["icao", "reg", "icaotype", "manufacturer", "model", "owner", "short_type"]
FLAG_FIELDS = ["faa_pia", "faa_ladd", "mil"]
TRIMMED_FIELDS = ["manufacturer", "model", "owner", "short_type"]


def scan_registry_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their source file; bad lines are marked, not dropped."""
    lines = (
        spark.read.schema(REGISTRY_LINE)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return lines.select("*", F.col("_metadata.file_path").alias("file_path"))


def parse_registry_lines(lines: DataFrame, line: str) -> DataFrame:
    """The same from a column of lines, with the other columns."""
    parsed = F.from_json(F.col(line), REGISTRY_LINE, {"columnNameOfCorruptRecord": CORRUPT})
    rest = [c for c in lines.columns if c != line]
    return lines.select(parsed.alias("parsed"), *rest).select("parsed.*", *rest)


def registry_records(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed registry rows of the readable lines, defaults for absent fields."""
    source = {"owner": "ownop"}

    def field(name: str) -> Column:
        raw = F.col(source.get(name, name))
        if name == "year":
            return numbers.year_or_null(raw)
        if name in FLAG_FIELDS:
            return numbers.flag_or_false(raw)
        return F.coalesce(raw, F.lit(""))

    good = lines.where(F.col(CORRUPT).isNull())
    return good.select(*[field(f.name).alias(f.name) for f in REGISTRY.fields], *keep)


def clean_registry(records: DataFrame) -> DataFrame:
    """Registry rows as they are stored in gold: no null text or flag, trimmed."""

    def field(name: str) -> Column:
        c = F.col(name)
        if name == "year":
            return c.try_cast("int")
        if name in FLAG_FIELDS:
            return F.coalesce(c, F.lit(False))
        if name in TRIMMED_FIELDS:
            c = text.strip_text(c)
        return F.coalesce(c, F.lit(""))

    known = [f.name for f in REGISTRY.fields]
    others = [c for c in records.columns if c not in known]
    return records.select(*[field(c).alias(c) for c in known], *others)
