"""Ordered pages: near ones by one top-k, deep ones from ranges of the order."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.session import scratch_path

#: Rows that a top-k may gather in a task; pages that end beyond come from ranges.
NEAR = 100_000


def page(df: DataFrame, num_results: int, page: int, order: list[str]) -> DataFrame:
    """Rows ``page * num_results`` onwards in the given order.

    A negative page is the first one, size 0 is an empty page. The order should
    name enough columns to be total, or ties may move between pages. A page that ends
    beyond ``NEAR`` rows is taken from `ranged`; who wants several of them calls
    that once.
    """
    if num_results < 0:
        raise ValueError(f"num_results must not be negative, got {num_results}")
    if num_results == 0:
        return df.limit(0)
    offset = max(page, 0) * num_results
    if offset + num_results > NEAR:
        return ranged(df, order).page(num_results, page)
    return df.orderBy(*order).offset(offset).limit(num_results)


@dataclass(frozen=True)
class Ranged:
    """Rows written in ranges of an order; ``starts[i]`` rows lie before range i."""

    rows: DataFrame
    columns: list[str]
    order: list[str]
    starts: list[int]

    def page(self, num_results: int, page: int) -> DataFrame:
        """As `page`: only the ranges that the page lies in are read, and of them the
        rows of the page are gathered."""
        first = max(page, 0) * num_results
        last = first + num_results
        wanted = [
            (F.col("_range") == i) & (F.col("_place") >= first - start) & (F.col("_place") < last - start)
            for i, (start, end) in enumerate(zip(self.starts, self.starts[1:], strict=False))
            if start < last and end > first
        ]
        if num_results <= 0 or not wanted:
            return self.rows.select(*self.columns).limit(0)
        found = self.rows.where(reduce(lambda a, b: a | b, wanted))
        return found.orderBy("_range", "_place").select(*self.columns).limit(num_results)


def ranged(df: DataFrame, order: list[str], ranges: int | None = None) -> Ranged:
    """Write the rows once in ranges of the order, sorted, with their place in the range.

    Each range is counted (the driver gets a number for each), and a page at any depth
    costs what it holds. ``ranges`` is the session's shuffle partitions by default. The
    rows lie under spark.checkpoint.dir.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pages")
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_range"), in_task.alias("_place"))
    )
    placed.write.partitionBy("_range").parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    counts = {r["_range"]: r["count"] for r in rows.groupBy("_range").count().toLocalIterator()}
    starts = list(accumulate((counts.get(i, 0) for i in range(max(counts, default=-1) + 1)), initial=0))
    return Ranged(rows, df.columns, order, starts)
