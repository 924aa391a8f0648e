"""Lineage columns of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEMS = ("bronze", "silver", "gold")


def lineage_values(
    file_location: Column | str,
    source_date: Column | str | None = None,
    systems: tuple[str, ...] = SYSTEMS,
) -> dict[str, Column]:
    """Lineage columns by name; text is a constant, a Column comes from the row."""
    columns = {} if source_date is None else {"source_date": _value(source_date)}
    return columns | {
        "_loaded_time": F.current_timestamp(),
        "_file_location": _value(file_location),
        "_systems_passed": F.array(*[F.lit(s) for s in systems]),
    }


def add_lineage(df: DataFrame, **values) -> DataFrame:
    """Append the lineage columns (arguments as for `lineage_values`)."""
    return df.withColumns(lineage_values(**values))


def _value(v: Column | str) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
