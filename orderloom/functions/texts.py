"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """Null, empty, or white space of any kind (`trim` would leave tabs)."""
    return text.isNull() | ~text.rlike(r"\S")


def is_missing(text: Column) -> Column:
    return text.isNull() | (text == F.lit(""))
