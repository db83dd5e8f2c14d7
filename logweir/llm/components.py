"""Connected components of a link table, by alternating star steps on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize

ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, component): the smallest node that each linked node reaches.

    Each round points every node at the smallest of its neighbours, so paths shrink by half.
    Minima are combined before they are shuffled, and stored, so that a join with the
    neighbours of a node with very many links can be split.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = materialize(links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    state = _state(edges)
    for _ in range(ROUNDS):
        if state[0] == 0:
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = materialize(least, "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.union(least).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    nodes = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return materialize(nodes.union(roots), "components")
