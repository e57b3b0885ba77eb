"""Connected components of a graph that is given as a table of edges.

Large-star and small-star turns: every node's neighbours are hung on the smallest of them, first those
above the node, then those below, until the edges form stars. A node with very many neighbours is
grouped with partial sums before the shuffle, and its rows are split by adaptive joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (high, low). Neighbours above each node, or those below and the node, hung on its smallest neighbour."""
    if large:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        # Written first, so that the join reads two plain tables and adaptive execution can split a node of many edges.
        least = stored(least.select("node", F.least("node", "least").alias("least")), "least")
        up = edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        out = up.join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
    else:
        least = stored(edges.groupBy("high").agg(F.min("low").alias("least")), "least")
        moved = edges.join(least, "high")
        out = moved.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
            least.select("high", F.col("least").alias("low")))
    return out.filter("high != low").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node and least (the smallest node of its component) for all nodes of edges but those smallest ones.

    Edges to oneself and edges with a null count for nothing; repeated edges count once.
    """
    a, b = F.col(left), F.col(right)
    state = stored(edges.filter(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct(), "edges")
    before = None
    while (now := _state(state)) != before:
        before = now
        state = stored(_star(stored(_star(state, large=True), "edges"), large=False), "edges")
    return state.select(F.col("high").alias("node"), F.col("low").alias("least"))
