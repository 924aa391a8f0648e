"""Text rules: trimming, canonical form, empty/null conventions, ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Unicode counts as white space, the escape
# sequences undone before comparing, the characters stripped around them, and
# the tokens removed from an id argument.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ESCAPES = [("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\\\", "\\")]
CANONICAL_EDGE = "\"' \t\n\r"
ID_TOKENS = ["'", ";", "--"]
ICAO_LENGTH = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Remove surrounding white space of any kind (plain trim knows only ' ')."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def canonical_text(c: Column | str) -> Column:
    """Form used when two registry texts are compared; never stored."""
    out = strip_text(c)
    for written, meant in ESCAPES:
        out = F.replace(out, F.lit(written), F.lit(meant))
    return F.btrim(out, F.lit(CANONICAL_EDGE))


def truncate_icao(c: Column | str, length: int = ICAO_LENGTH) -> Column:
    return F.substring(_col(c), 1, length)


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def empty_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty text becomes null in the given (default: all) text columns."""
    names = set(columns) if columns is not None else _text_columns(df)
    return df.select(
        *[null_if_empty(c).alias(c) if c in names else F.col(c) for c in df.columns]
    )


def null_to_default(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing value becomes the column's default, types unchanged."""
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit(defaults[f.name]).cast(f.dataType)).alias(f.name)
            if f.name in defaults
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clean_id(c: Column | str) -> Column:
    """Id column without quote, semicolon and double dash."""
    out = _col(c)
    for token in ID_TOKENS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def clean_id_argument(value: str) -> str:
    """The same rule for an id passed as an argument."""
    for token in ID_TOKENS:
        value = value.replace(token, "")
    return value


def is_filled(c: Column | str) -> Column:
    """Neither null nor empty; both halves can be pushed to a Parquet scan."""
    c = _col(c)
    return c.isNotNull() & (c != "")


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
