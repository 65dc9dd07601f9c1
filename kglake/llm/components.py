"""Connected components of a table of links, with lineage cut every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.llm import shared


def components(links: DataFrame) -> DataFrame:
    """`node, root`: the least node reachable, for every node of `links` (`a, b`, both long).

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its least
    neighbour, then every node and its smaller neighbours to the least of them. Partial minima meet a node with very many
    links before the shuffle, and a chain halves in each round.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = shared.stored(edges, "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = shared.stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                              .where("a <> b").distinct(), "links")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            smallest.select("a", F.col("m").alias("b"))).distinct()
        after = shared.stored(small, "links")
        # Settled when a round leaves the same links.
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        edges = after
        if state == before:
            break
        before = state
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(
        roots.select("node"), "node", "left_anti"))
