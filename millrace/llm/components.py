"""Connected components of links as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, join_groups


def roots(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs to (node, root): every node that isn't the smallest of its component, and that smallest.

    Alternates two steps until nothing changes: each node hands its larger neighbours, then its smaller ones, to the
    smallest node around it. Both keep what is connected connected and turn every component into a star around its
    root, in a number of rounds that grows with the logarithm of its size. A node with many neighbours is only ever seen through
    the minimum and count of its links, which are aggregated before the shuffle, and joined back by broadcast where heavy.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        larger = _hooked(both, 2 * state[0], F.col("root") > F.col("node"))
        stars = cut(larger.select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root").distinct())
        n = stars.count()
        smaller = _hooked(stars, n, F.lit(True))
        linked = smaller.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(smaller.select("node", F.col("least").alias("root")))
        edges = cut(linked.where("node <> root").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())


def _hooked(edges: DataFrame, total: int, which) -> DataFrame:
    """The chosen (node, root) pairs with the smallest of the node and all its neighbours."""
    least = edges.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("least"), F.count("*").alias("degree"))
    return join_groups(edges.where(which), least, "node", "degree", total)
