"""Tolerant conversions.

Spark 4 runs with ANSI mode on, where a bad cast raises. The pipeline's contract is the
non-ANSI one (a bad value becomes null and counters then become 0), so every conversion
of raw text goes through ``try_*`` functions instead of switching ANSI off globally.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlake.functions.metrics import col


def to_long(c: str | Column) -> Column:
    return col(c).try_cast("long")


def to_double(c: str | Column) -> Column:
    return col(c).try_cast("double")


def to_bool(c: str | Column) -> Column:
    return col(c).try_cast("boolean")


def to_ts(c: str | Column) -> Column:
    """ISO-8601 text (with or without offset) -> timestamp; junk -> null."""
    return F.try_to_timestamp(col(c).cast("string"))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0).cast("long"))


def norm_region(c: str | Column = "region") -> Column:
    return F.lower(F.trim(col(c)))
