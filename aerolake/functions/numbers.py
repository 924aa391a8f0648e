"""Number rules for text columns and for JSON tokens of mixed type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in text, as a whole number in text,
# and the word the altitude field carries for an aircraft on the ground.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
)
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"
GROUND = "ground"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c: Column | str) -> Column:
    """Text to double, null when it is not a number.

    A bare cast would also take Java spellings such as ``12d``.
    """
    c = _col(c)
    return F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))


def int_or_null(c: Column | str) -> Column:
    """Altitude policy for text: truncate to int, anything else is null."""
    return parse_double(c).try_cast("int")


def zero_fill_long(c: Column | str) -> Column:
    """Altitude policy for text: non-numeric and ``ground`` become 0."""
    return F.coalesce(parse_double(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def zero_fill_double(c: Column | str) -> Column:
    """Non-numeric, null and NaN become 0.0."""
    zero = F.lit(0.0)
    return F.coalesce(F.nanvl(parse_double(c), zero), zero)


def number_or_zero(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """Number in the column, or 0.0; text is parsed, other types are cast."""
    c = _col(c)
    if data_type is not None and not isinstance(data_type, T.StringType):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    return F.coalesce(parse_double(c), F.lit(0.0))


def year_or_null(c: Column | str) -> Column:
    return parse_double(c).try_cast("bigint")


def flag_or_false(c: Column | str) -> Column:
    return F.coalesce(_col(c).try_cast("boolean"), F.lit(False))


# --- JSON tokens -----------------------------------------------------------


def _kind(token: Column) -> Column:
    return F.schema_of_variant(token)


def _is_number(token: Column) -> Column:
    kind = _kind(token)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def token_text(c: Column | str) -> Column:
    """Altitude policy ``raw``: the token as it was found."""
    return F.try_variant_get(_col(c), "$", "string")


def token_number(c: Column | str) -> Column:
    """Value of a JSON *number*; text, booleans, null and absence give null."""
    c = _col(c)
    return F.when(_is_number(c), F.try_variant_get(c, "$", "double"))


def token_int_or_null(c: Column | str) -> Column:
    """Altitude policy ``int_or_null``.

    Numbers are truncated, whole-number text is taken, other text is null.
    """
    c = _col(c)
    text = token_text(c)
    return (
        F.when(_is_number(c), F.try_variant_get(c, "$", "double").try_cast("int"))
        .when(_kind(c) == "BOOLEAN", F.try_variant_get(c, "$", "boolean").cast("int"))
        .when(text.rlike(WHOLE_TEXT), F.btrim(text).try_cast("int"))
    )


def token_zero_fill(c: Column | str) -> Column:
    """Altitude policy ``zero_fill``: any numeric token or text, else 0."""
    c = _col(c)
    number = (
        F.when(_is_number(c), F.try_variant_get(c, "$", "double"))
        .when(_kind(c) == "BOOLEAN", F.try_variant_get(c, "$", "boolean").cast("double"))
        .otherwise(parse_double(token_text(c)))
    )
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def token_double(c: Column | str) -> Column:
    """Numeric token or numeric text as double, anything else null."""
    c = _col(c)
    return F.when(_is_number(c), F.try_variant_get(c, "$", "double")).otherwise(
        parse_double(token_text(c))
    )
