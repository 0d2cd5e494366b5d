"""Systematic, random, exact-size and stratified samples.

Random choices come from a hash of the row key, so the same rows are drawn whatever the
partitioning, after a retry, and in another engine. Keys must identify a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from emberline.functions.hashing import HASH_SPAN, below, hash32
from emberline.schemas import TARGET

# Exact sizes: the hash of the k-th row lies within so many standard deviations of its expected place.
DEVIATIONS = 8.0


def step_for(total: int, wanted: int) -> int:
    return max(1, total // wanted)


def step_of_fraction(frac: float) -> int:
    return max(1, int(1 / frac))


def every_kth(df: DataFrame, step: int | Column, position: str = "position") -> DataFrame:
    """Rows 0, k, 2k ... of a table with a position column; ceil(n / k) rows."""
    return df.where(F.col(position) % step == 0)


def systematic_sample(df: DataFrame, wanted: int, position: str = "position") -> DataFrame:
    """Every k-th row with k = max(1, rows // wanted), the count being a scalar subquery."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    step = F.greatest(F.lit(1), F.floor(total / wanted))
    return every_kth(df, step, position)


def map_sample(df: DataFrame, wanted: int = 50_000, position: str = "position") -> DataFrame:
    return systematic_sample(df, wanted, position).select("latitude", "longitude")


def prefix_fraction(df: DataFrame, frac: float, position: str = "position") -> DataFrame:
    """The first int(rows * frac) rows by position."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return df.where(F.col(position) < F.floor(total * F.lit(float(frac))))


def bernoulli(df: DataFrame, frac: float, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """Every row with the same chance. With ``keys`` the choice depends on the row alone."""
    if keys is None:
        return df.sample(frac, seed)
    return df.where(below(hash32(keys, seed), frac))


def _brackets(quotas: Sequence[int], n: int, wide: float) -> list[tuple[int, int]]:
    """Hash ranges in which the k-th smallest of n hashes lie, for all quotas k; ranges that touch are one."""
    found = []
    for k in sorted(q for q in quotas if 0 < q < n):
        share = k / n
        margin = wide * ((share * (1 - share) / n) ** 0.5 + 1 / n)
        low, high = max(0, int((share - margin) * HASH_SPAN)), min(HASH_SPAN, int((share + margin) * HASH_SPAN) + 1)
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found


def _limits(hashed: DataFrame, keys: Sequence[str], group: Column, quotas: dict, sizes: dict) -> dict:
    """(group, k) -> condition that holds for the k rows of a group with the smallest hashes, equal ones by key.

    One scan: rows outside the brackets around the expected hashes are only counted, those inside (some sixteen
    times the root of the row count for a limit) are ordered. A bracket that turns out not to hold its limit is
    made wider; the conditions are exact.
    """
    known, wide = {}, DEVIATIONS
    place = F.struct("_hash", *keys)
    for g, ks in quotas.items():
        known |= {(g, k): F.lit(k > 0) for k in ks if not 0 < k < sizes[g]}
    while any((g, k) not in known for g, ks in quotas.items() for k in ks):
        inside, start = F.lit(False), F.lit(0).cast("bigint")
        open_groups = [g for g, ks in quotas.items() if any((g, k) not in known for k in ks)]
        for g in open_groups:
            for low, high in _brackets(quotas[g], sizes[g], wide):
                here = group.eqNullSafe(F.lit(g))
                inside = inside | (here & F.col("_hash").between(low, high - 1))
                start = F.when(here & (F.col("_hash") >= high), F.lit(high).cast("bigint")).otherwise(start)
        marked = hashed.where(group.isin(*open_groups)).select(
            group.alias("_group"), F.when(inside, F.col("_hash")).otherwise(start).alias("_from"), F.when(inside, place).alias("_place")
        )
        counted = marked.groupBy("_group", "_from", "_place").agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_group").orderBy("_from", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counted.withColumn("_upto", F.sum("_n").over(upto))
        wanted = [(g, k) for g in open_groups for k in quotas[g] if (g, k) not in known]
        firsts = [
            F.min(F.when((F.col("_group") == F.lit(g)) & (F.col("_upto") >= k), F.struct("_from", F.col("_place").isNotNull().alias("_sure"), "_place"))).alias(f"l{i}")
            for i, (g, k) in enumerate(wanted)
        ]
        for at, limit in zip(wanted, summed.agg(*firsts).first(), strict=True):
            if limit is not None and limit["_sure"]:
                values = [F.lit(limit["_place"][c]).cast(t) for c, t in hashed.select("_hash", *keys).dtypes]
                known[at] = place <= F.struct(*[v.alias(c) for v, c in zip(values, ["_hash", *keys], strict=True)])
        wide *= 16
    return known


def exact_fraction(
    df: DataFrame, frac: float, keys: Sequence[str], seed: int = 42, rounding: str = "down"
) -> DataFrame:
    """int(n * frac) or round(n * frac) rows without replacement: those with the smallest hash.

    Two scans besides the count: one to find the limit, one to take the rows; no row is shuffled but those near
    the limit. Rows with equal keys are on one side of it.
    """
    n = df.count()
    quota = int(n * frac) if rounding == "down" else round(n * frac)
    hashed = df.withColumn("_hash", hash32(keys, seed))
    limit = _limits(hashed, keys, F.lit(0), {0: [quota]}, {0: n})[0, quota]
    return hashed.where(limit).select(*df.columns)


# Percentage of the rows in each of the three parts.
SPLITS = {"train": 70, "val": 15, "test": 15}


def _by_threshold(hashed: Column) -> Column:
    train, val = SPLITS["train"], SPLITS["train"] + SPLITS["val"]
    return F.when(below(hashed, train / 100), "train").when(below(hashed, val / 100), "val").otherwise("test")


def stratified_split(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Add ``split`` by the hash of the row key. No shuffle; every class is cut at the same hash limits,
    so each part has the class shares of the table up to chance."""
    return df.withColumn("split", _by_threshold(hash32(keys, seed)))


def split_sizes(counts: DataFrame) -> DataFrame:
    """Rows per class and part (``n_train``, ``n_val``, ``n_test``) for rows ``(class, n)``.

    30 % of all rows, rounded up, leave the training part, and half of them, rounded up, form the test
    part. Both are shared among the classes by size, remainders going to the largest fractions.
    """
    # One row per class; whole numbers of any size stay exact.
    out_of_train = 100 - SPLITS["train"]
    total = F.sum("n").over(Window.partitionBy())
    sized = counts.withColumn("_all", total).withColumn(
        "_rest", F.call_function("div", F.col("_all") * out_of_train + 99, F.lit(100))
    )
    held = _shared(sized, "n", F.col("_rest"), F.col("_all"), "_held")
    half = F.call_function("div", F.col("_rest") + 1, F.lit(2))
    tested = _shared(held, "_held", half, F.col("_rest"), "n_test")
    return tested.select(
        "class",
        "n",
        (F.col("n") - F.col("_held")).alias("n_train"),
        (F.col("_held") - F.col("n_test")).alias("n_val"),
        "n_test",
    )


def _shared(df: DataFrame, size: str, part: Column, whole: Column, out: str) -> DataFrame:
    """Split ``part`` among the classes in proportion to ``size`` by largest remainder."""
    wide = "decimal(19,0)"
    scaled = F.col(size).cast(wide) * part.cast(wide)
    floored = df.withColumn("_floor", F.call_function("div", scaled, whole.cast(wide)))
    remaining = scaled - F.col("_floor").cast(wide) * whole.cast(wide)
    order = Window.orderBy(F.desc("_remainder"), "class")
    missing = part - F.sum("_floor").over(Window.partitionBy())
    extra = F.when(F.row_number().over(order) <= missing, 1).otherwise(0)
    return (
        floored.withColumn("_remainder", remaining)
        .withColumn(out, F.col("_floor") + extra)
        .drop("_floor", "_remainder")
    )


def exact_stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    target: str = TARGET,
    classes: Sequence = (0, 1),
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` with the exact sizes of ``split_sizes``.

    Within a class the rows are ordered by hash, equal ones by key. One scan counts the classes, one finds the two
    limits of every class, and the labels are a condition on hash and key: no row is shuffled but those near a
    limit. Rows of a class that is not listed are cut by hash thresholds.
    """
    counts = df.where(F.col(target).isin(*classes)).groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["class"]: r for r in split_sizes(counts).collect()}  # one row per listed class
    hashed = df.withColumn("_hash", hash32(keys, seed))
    ends = {c: [r["n_train"], r["n_train"] + r["n_val"]] for c, r in sizes.items()}
    limits = _limits(hashed, keys, F.col(target), ends, {c: r["n"] for c, r in sizes.items()})
    split = _by_threshold(F.col("_hash"))
    for c, (train, before) in ends.items():
        own = F.when(limits[c, train], "train").when(limits[c, before], "val").otherwise("test")
        split = F.when(F.col(target) == F.lit(c), own).otherwise(split)
    return hashed.withColumn("split", split).select(*df.columns, "split")
