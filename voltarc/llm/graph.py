"""Connected components of an edge table, as alternating large-star and small-star rounds of joins and aggregates.

No neighbourhood is ever collected: a node's smallest neighbour is an aggregate with partial sums. It is written before it
is joined back, so that both sides of the join are plain exchanges and Spark can split a hub's rows among tasks; tables
that a round has replaced are deleted. The rounds end when an edge table repeats itself, which these two steps reach for
every graph, in about the logarithm of its longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle, unsettle


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).collect()[0]
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of the undirected edges (a, b): root is the smallest id of its component."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = settle(pairs, "edges")
    before, state = None, _state(pairs)
    while state[0] and state != before:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "lows")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        replaced, pairs = pairs, settle(small, "edges")
        before, state = state, _state(pairs)
        unsettle(replaced)
        unsettle(low)
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
