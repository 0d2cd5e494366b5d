"""Places of rows within groups of any size, by a seeded order.

A group is cut into cells by the top bits of a hash; cells are counted (merged before the shuffle) and
added up, and only the rows of one cell are ever sorted together. A group that holds a third of the rows
is spread over all its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CELLS = 1024


def with_place(df: DataFrame, keys: list[str], order: list[Column], seed: int, cells: int = CELLS) -> DataFrame:
    """``df`` with ``place`` (from 0) of every row in its group, by hash of ``order``, then by ``order``.

    Groups are compared null-safe. Rows equal in ``order`` get different places in any order, so they should
    then be equal in all that matters.
    """
    spread = F.xxhash64(F.lit(seed), *order)
    split = df.withColumn("_h", spread).withColumn("_cell", F.pmod(F.shiftright("_h", 20), F.lit(cells)))
    sizes = split.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    same = F.col("_cell") == F.col("_c")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    in_cell = Window.partitionBy(*keys, "_cell").orderBy("_h", *order)
    placed = split.withColumn("_r", F.row_number().over(in_cell)).join(starts, same)
    return placed.withColumn("place", F.col("_start") + F.col("_r") - 1).drop(
        "_h", "_cell", "_c", "_start", "_r", *[f"_k{i}" for i in range(len(keys))]
    )
