"""Guarded arithmetic (F4 SAFE_DIVIDE, F6 NULLIF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null when the divisor is zero or null; never raises (SAFE_DIVIDE)."""
    return F.try_divide(numerator, denominator)


def nullif(value: Column, sentinel=0) -> Column:
    """NULLIF(value, sentinel)."""
    return F.nullif(value, F.lit(sentinel))
