"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from orderloom.session import work_dir


def left_join_unique(big: DataFrame, unique: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join `big` to a side with at most one row per key.

    The unique side comes out of an aggregate, which keeps AQE from splitting a key of `big` with
    very many rows. Written as a table first it is a plain scan like the other side: AQE then splits
    what is skewed, at any size, and each input is read once.
    """
    path = work_dir(unique.sparkSession, "unique")
    unique.write.parquet(path)
    stored = unique.sparkSession.read.schema(unique.schema).parquet(path)
    return big.join(stored, list(key), "left")
