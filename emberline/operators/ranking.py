"""Running totals, ranks and exact quantiles that no single task has to hold.

A window without partition keys would move a whole table into one task. Here the rows are cut
into value ranges first, every range is summed on its own, and only one row per range is added
up in order. The cost is one extra pass over the (already grouped) rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

def range_count(df: DataFrame) -> int:
    """How many value ranges to cut where the caller does not say: the shuffle width of the session."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where a null key meets a null key; the key columns come from the left."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def with_value_range(
    df: DataFrame, order: str, sums: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Number the value ranges of a numeric column so that each holds about the same row count.

    The limits come from a quantile sketch of fixed size, read as a scalar subquery. Rows with the
    same value always get the same range. The summed columns (counts, never negative) take part in
    the sketch's input so that Spark sees the same columns and reuses the shuffle of the main query.
    """
    ranges = ranges or range_count(df)
    cuts = [i / ranges for i in range(1, ranges)]
    counted = F.greatest(*[F.col(s) for s in sums], F.lit(0)) >= 0
    limits = df.agg(F.percentile_approx(F.when(counted, F.col(order)), cuts, 10 * ranges).alias("fine"))
    below = lambda values: F.coalesce(F.size(F.filter(values, lambda x: x < F.col(order))), F.lit(0))
    # Two steps over the square root of the limits each, instead of one over all of them.
    step = math.isqrt(ranges)
    coarse = F.filter("fine", lambda _, i: (i + 1) % step == 0).alias("coarse")
    placed = df.withColumn("_limits", limits.select(F.struct("fine", coarse).alias("limits")).scalar())
    return (
        placed.withColumn("_jump", below(F.col("_limits.coarse")) * step)
        .withColumn("_range", F.col("_jump") + below(F.slice("_limits.fine", F.col("_jump") + 1, F.lit(step))))
        .drop("_limits", "_jump")
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add ``before_<s>`` (sum over smaller ``order`` values) and ``total_<s>`` for each of ``sums``.

    ``df`` holds one row per (``by``, ``order``); group it first, which also merges ties.
    """
    by = list(by)
    ranged = with_value_range(df, order, sums, ranges)
    cells = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_cell_{s}") for s in sums])
    # At most `ranges` rows per `by` key reach one task here, whatever the size of the table.
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        *by,
        "_range",
        *[F.sum(f"_cell_{s}").over(earlier).alias(f"_offset_{s}") for s in sums],
        *[F.sum(f"_cell_{s}").over(whole).alias(f"total_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    joined = null_safe_join(ranged, offsets, [*by, "_range"]) if by else ranged.join(offsets, "_range")
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"_offset_{s}"), zero) + F.coalesce(F.sum(s).over(inside), zero)).alias(f"before_{s}")
            for s in sums
        ],
        *[f"total_{s}" for s in sums],
    )


def with_rank(df: DataFrame, key: str, out: str = "position", ranges: int | None = None) -> DataFrame:
    """Zero-based position of every row in the order of a unique numeric key."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(counted, key, ["_one"], ranges=ranges)
    return ranked.withColumnRenamed("before__one", out).drop("_one", "total__one")


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null value; partial counts are merged before the shuffle."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _value_at(position: Column) -> Column:
    hit = (F.col("before_n") <= position) & (position < F.col("before_n") + F.col("n"))
    return F.max(F.when(hit, F.col("value")))


def quantile_column(p: float, method: str = "linear") -> Column:
    """Aggregate over the result of ``running_totals(value_counts(...), "value", ["n"])``.

    ``linear`` interpolates between the two neighbours, ``discrete`` gives the first value whose
    share of rows reaches ``p``, ``nearest`` the value at the rounded position.
    """
    last = F.col("total_n") - 1
    at = last * F.lit(float(p))
    if method == "linear":
        low = _value_at(F.floor(at))
        high = _value_at(F.ceil(at))
        share = F.max(at - F.floor(at))
        return low + (high - low) * share
    if method == "discrete":
        return _value_at(F.greatest(F.ceil(F.col("total_n") * F.lit(float(p))) - 1, F.lit(0)))
    if method == "nearest":
        return _value_at(F.floor(at + 0.5))
    raise ValueError(f"unknown quantile method: {method}")


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    method: str = "linear",
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles per ``by`` group: one output column per entry of ``probs``."""
    ranked = running_totals(value_counts(df, col, by), "value", ["n"], by, ranges)
    columns = [quantile_column(p, method).alias(name) for name, p in probs.items()]
    return ranked.groupBy(*by).agg(*columns) if by else ranked.agg(*columns)
