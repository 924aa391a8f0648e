"""Expressions over file names and contents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the version marker inside a file name.
VERSION_PATTERN = r"_v(\d+)\."
LEADING_VERSION_PATTERN = r"^(\d+)_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def name_version(path: Column | str) -> Column:
    """Version in ``…_v12.json.gz``; 0 when the name carries none."""
    found = F.regexp_extract(file_name(path), VERSION_PATTERN, 1)
    return F.coalesce(found.try_cast("int"), F.lit(0))


def leading_version(path: Column | str) -> Column:
    """Version in ``12_….json.gz``; null when the name does not start with one."""
    return F.regexp_extract(file_name(path), LEADING_VERSION_PATTERN, 1).try_cast("int")


def content_hash(content: Column | str) -> Column:
    return F.sha2(_col(content).cast("binary"), 256)


def is_gzip(content: Column | str) -> Column:
    """True when the bytes start with the gzip magic number."""
    return F.hex(F.substring(_col(content), 1, 2)) == "1F8B"
