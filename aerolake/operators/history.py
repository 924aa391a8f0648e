"""Registry history with validity ranges (SCD type 2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.text import canonical_text
from aerolake.functions.times import utc
from aerolake.operators.filters import current_only
from aerolake.schemas import REGISTRY

KEY = "icao"
FIELDS = [f.name for f in REGISTRY.fields]
HISTORY_FIELDS = FIELDS + ["valid_from", "valid_to", "is_current", "version", "source_date"]


def one_row_per_key(incoming: DataFrame, key: str = KEY) -> DataFrame:
    """One incoming row per key (the smallest), plus how many there were.

    An aggregate, not a window: copies of one key combine before the shuffle.
    """
    rest = [c for c in incoming.columns if c != key]
    picked = incoming.groupBy(key).agg(
        F.min(F.struct(*rest)).alias("row"), F.count("*").alias("copies")
    )
    return picked.select(*[F.col(key) if c == key else F.col(f"row.{c}") for c in incoming.columns], "copies")


def classify(incoming: DataFrame, history: DataFrame, key: str = KEY) -> DataFrame:
    """Incoming rows with ``change``: ``new``, ``changed`` or ``same``."""
    current = current_only(history).select(*FIELDS)
    joined = _as_new(incoming).join(current, F.col(f"new_{key}") == F.col(key), "left")
    return joined.select(
        *[F.col(f"new_{c}").alias(c) for c in incoming.columns],
        _change(incoming.schema, key).alias("change"),
    )


def close_rows(
    history: DataFrame, keys: DataFrame, closed_at: datetime | Column, key: str = KEY
) -> DataFrame:
    """Current rows of the given keys end at ``closed_at``; others are as before.

    Closed rows can no longer change, so only current ones are joined.
    """
    hit = keys.select(F.col(key).alias("hit_key")).distinct()
    current = current_only(history)
    joined = current.join(hit, current[key] == F.col("hit_key"), "left")
    ended = F.col("hit_key").isNotNull()
    rewritten = joined.select(
        *[
            F.when(ended, _timestamp(closed_at)).otherwise(F.col(c)).alias(c)
            if c == "valid_to"
            else (F.col(c) & ~ended).alias(c)
            if c == "is_current"
            else current[c].alias(c)
            for c in history.columns
        ]
    )
    return history.where("NOT is_current").unionByName(rewritten)


def next_version(history: DataFrame) -> DataFrame:
    """Single value: one more than the highest version, 1 for an empty history."""
    return history.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def merge_current(
    current: DataFrame,
    incoming: DataFrame,
    *,
    loaded_at: datetime | Column,
    source_date: str,
    version: int | Column,
    lineage: dict[str, Column] | None = None,
    key: str = KEY,
    copies: str | None = None,
) -> DataFrame:
    """Current rows after a load, together with the ones it closes.

    One full join by key decides everything: a row that did not change or is
    not in the load stays, a changed one comes out closed and re-opened, a new
    one is opened. The raw values are stored; only the comparison is canonical.
    ``lineage`` gives opened rows their values of any further column of
    ``current``; rows already there keep theirs. ``copies`` names a further column with
    the number of incoming rows that had the row's key, null for those not in the load.
    """
    load = one_row_per_key(incoming.select(*FIELDS), key)
    opening = {
        **(lineage or {}),
        "valid_from": _timestamp(loaded_at),
        "is_current": F.lit(True),
        "version": version if isinstance(version, Column) else F.lit(version),
        "source_date": F.lit(source_date),
    }
    joined = current.join(_as_new(load), F.col(key) == F.col(f"new_{key}"), "full_outer")
    change = F.when(F.col(f"new_{key}").isNull(), "kept").otherwise(_change(load.schema, key))
    joined = joined.withColumns(
        {"change": change, **{f"open_{c}": value for c, value in opening.items()}}
    )

    def row(values: dict[str, str], counted: str) -> str:
        counted_rows = [f"'{copies}', CAST({counted} AS bigint)"] if copies else []
        columns = [
            f"'{f.name}', CAST({values.get(f.name, f.name)} AS {f.dataType.simpleString()})"
            for f in current.schema.fields
        ]
        return f"named_struct({', '.join(columns + counted_rows)})"

    kept = row({}, "new_copies")
    closed = row({"valid_to": "open_valid_from", "is_current": "false"}, "NULL")
    opened = row(
        {c: "NULL" for c in current.columns}
        | {c: f"new_{c}" for c in FIELDS}
        | {c: f"open_{c}" for c in opening},
        "new_copies",
    )
    outcome = F.expr(
        f"""CASE change WHEN 'new' THEN array({opened})
                        WHEN 'changed' THEN array({closed}, {opened})
                        ELSE array({kept}) END"""
    )
    return joined.select(F.explode(outcome).alias("row")).select("row.*")


def merge(
    history: DataFrame,
    incoming: DataFrame,
    *,
    loaded_at: datetime | Column,
    source_date: str,
    version: int | Column | None = None,
    lineage: dict[str, Column] | None = None,
    key: str = KEY,
) -> DataFrame:
    """Whole history after a load. Closed rows pass by without a shuffle."""
    if version is None:
        version = next_version(history).scalar()
    after = merge_current(
        current_only(history),
        incoming,
        loaded_at=loaded_at,
        source_date=source_date,
        version=version,
        lineage=lineage,
        key=key,
    )
    return history.where("NOT is_current").unionByName(after)


def _as_new(incoming: DataFrame) -> DataFrame:
    return incoming.selectExpr(*[f"{c} AS new_{c}" for c in incoming.columns])


def _change(schema: T.StructType, key: str) -> Column:
    """Change of the incoming row (``new_…``) against the current one.

    Texts are compared as they stand first; only differing ones are made
    canonical. Everything else is compared as whole numbers.
    """
    compared = [c for c in FIELDS if c != key]
    texts = [c for c in compared if isinstance(schema[c].dataType, T.StringType)]

    def text_values(prefix: str) -> Column:
        return F.array(*[f"{prefix}{c}" for c in texts])

    def numbers(prefix: str) -> Column:
        others = [c for c in compared if c not in texts]
        return F.array(*[F.col(f"{prefix}{c}").cast("bigint") for c in others])

    new, old = text_values("new_"), text_values("")
    same_texts = new.eqNullSafe(old) | F.transform(new, canonical_text).eqNullSafe(
        F.transform(old, canonical_text)
    )
    same = numbers("new_").eqNullSafe(numbers("")) & same_texts
    return F.when(F.col(key).isNull(), "new").when(same, "same").otherwise("changed")


def _timestamp(at: datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(utc(at)).cast("timestamp")
