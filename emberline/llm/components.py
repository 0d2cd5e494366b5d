"""Connected components of a graph that is only ever a table.

Alternating star contraction: every round points the neighbours of a node at the smallest node it knows,
first the larger ones, then the smaller ones. Edges never leave the executors; a round is a few keyed
aggregations and joins, and its result is checkpointed. The number of rounds grows with the logarithm of
the graph's diameter. Nodes with very many neighbours are merged before the shuffle and split in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from emberline.session import cut_lineage


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).head()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); root is the smallest node it reaches, itself included.

    Links of a node with itself and null ends are ignored. Only counts and checksums reach the driver.
    """
    now = cut_lineage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before, after = None, mark(now)
    while before != after:
        now = cut_lineage(small_star(large_star(now)))
        before, after = after, mark(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
