"""Row-level rules as built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_token(c: Column) -> Column:
    """Last space-separated word of a name (e.g. the pack size in a product name)."""
    return F.element_at(F.split(c, " "), -1)


def is_weekend(d: Column) -> Column:
    """1 on Saturday or Sunday (``weekday``: Monday = 0)."""
    return (F.weekday(d) >= 5).cast("int")


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def padded_id(prefix: str, n: Column, width: int) -> Column:
    """``prefix`` + ``n`` zero-padded to ``width`` digits."""
    return F.format_string(f"{prefix}%0{width}d", n)


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)
