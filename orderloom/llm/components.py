"""Connected components of links, in rounds over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of `links` (a, b).

    In a round every node takes the least of itself and its neighbours, goes on along these choices
    a few steps, and the links are carried over to where their ends have come; links within one
    node vanish. A star or a set of copies is done in one round, a chain in a number of rounds that
    grows with the logarithm of its length. Minima are combined before the shuffle, so a node with
    very many links is no heavy task; every step is a stored table.
    """
    links = written(links.select("a", "b").where("a <> b").distinct(), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    whole = None
    while True:
        step = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("root")), "step")
        for _ in range(2):
            step = _followed(step, step)
        step = written(step, "steps")
        whole = step if whole is None else written(_followed(whole, step), "roots")
        at = step.select(F.col("node").alias("a"), F.col("root").alias("a_root"))
        bt = step.select(F.col("node").alias("b"), F.col("root").alias("b_root"))
        links = written(links.join(at, "a").join(bt, "b").where("a_root <> b_root").select(
            F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
            .distinct(), "links")
        if links.isEmpty():
            return whole
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _followed(steps: DataFrame, by: DataFrame) -> DataFrame:
    """`steps` with each root replaced by the root it has in `by`, if any."""
    then = by.select(F.col("node").alias("root"), F.col("root").alias("then"))
    return steps.join(then, "root", "left").select("node", F.coalesce("then", "root").alias("root"))
