"""Lenient casts.

Spark 4 runs with ANSI mode on, where ``cast('zz' as bigint)`` raises.  The
pipeline must turn bad values into NULL (and count them), so every cast on
landed text goes through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """String -> int; ``'3.0'`` and junk give NULL."""
    return _c(c).try_cast("int")


def to_bigint(c) -> Column:
    return _c(c).try_cast("bigint")


def to_double(c) -> Column:
    """String -> finite double; junk, ``'NaN'`` and infinities give NULL."""
    d = _c(c).try_cast("double")
    return F.when(F.abs(d) < float("inf"), d)


def to_date(c) -> Column:
    """``'2022-11-14 10:11:12'`` -> 2022-11-14, ``'2022'`` -> 2022-01-01, junk -> NULL."""
    return _c(c).try_cast("date")


def safe_get(arr, i: int) -> Column:
    """Array element by 0-based index, NULL past the end (no ANSI error)."""
    return F.get(_c(arr), F.lit(i))
