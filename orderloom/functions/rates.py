"""Ratios in exact decimals, so that halves round away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COUNT = "decimal(20,0)"


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole; null when whole is zero."""
    return F.round(part.cast(_COUNT) / F.nullif(whole.cast(_COUNT), F.lit(0).cast(_COUNT)), digits)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with two decimals; null when whole is zero."""
    return F.round(part.cast(_COUNT) * F.lit(100) / F.nullif(whole.cast(_COUNT),
                                                            F.lit(0).cast(_COUNT)), 2)
