"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (a, b) with a > b.

    The smallest neighbours are staged, so in the join every node stands once
    on their side and the node with most edges on the other can be split.
    """
    if large:
        # every node with all its neighbours; the larger ones move to the smallest
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        moved = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = stage(edges.groupBy("a").agg(F.min("b").alias("m")), "low")
        moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two edges down, and no node that has one is another's end."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    ends = edges.groupBy(F.col("b").alias("a")).agg(F.lit(1).alias("is_end"))
    return edges.select("a").join(ends, "a", "left_semi").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) with b the smallest node that a reaches, for each node of ``edges`` but the smallest ones.

    Alternates large-star and small-star steps, each a grouped minimum and a
    join, until the edges are stars around smallest nodes. ``edges`` has the columns a and b
    of one orderable type; direction, repeats and self loops do not matter.
    """
    kind = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stage(edges.where(F.col("a") != F.col("b")).select(*kind).distinct(), "edges")
    for _ in range(most_rounds):
        if _settled(now):
            return now
        now = stage(_star(_star(now, large=True), large=False), "edges")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches over pairs of places: for the links of one block."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
