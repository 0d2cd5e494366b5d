"""Profiling queries: counts, series, shares, statistics, correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from emberline.functions.features import (
    has,
    numeric_predictors,
    with_delta_t,
    with_grid_cell,
    with_hour,
    with_month,
)
from emberline.operators.ranking import exact_quantiles, quantile_column, running_totals, value_counts
from emberline.schemas import TARGET

def rows_counted() -> Column:
    return F.count(F.lit(1)).alias("n")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(rows_counted())


def date_range(df: DataFrame, col: str = "acq_date") -> DataFrame:
    return df.agg(F.min(col).alias("first_date"), F.max(col).alias("last_date"))


def null_profile(df: DataFrame) -> DataFrame:
    """Type, nulls and their share for every column, counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").alias("nulls"),
            F.try_divide(F.col(f"`{f.name}`") * 100.0, F.col("_rows")).alias("pct_nulls"),
        )
        for f in df.schema
    ]
    return counts.select(F.inline(F.array(*entries))).orderBy(F.desc("pct_nulls"), "column")


def dataset_profile(df: DataFrame, date_col: str = "acq_date") -> DataFrame:
    """Rows, columns, date range and per-column nulls in one pass, one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(date_col).alias("_first"),
        F.max(date_col).alias("_last"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    entries = [
        F.struct(
            F.col("_rows").alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.col("_first").alias("first_date"),
            F.col("_last").alias("last_date"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").alias("nulls"),
        )
        for f in df.schema
    ]
    return counts.select(F.inline(F.array(*entries)))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(rows_counted())


def daily_series(df: DataFrame) -> DataFrame:
    return counts_by(df, "acq_date").orderBy("acq_date")


def monthly_counts(df: DataFrame) -> DataFrame:
    return counts_by(with_month(df), "month").orderBy("month")


def hourly_counts(df: DataFrame) -> DataFrame:
    return counts_by(with_hour(df), "hour").orderBy("hour")


def grid_density(df: DataFrame, decimals: int = 0) -> DataFrame:
    return counts_by(with_grid_cell(df.select("latitude", "longitude"), decimals), "lat_bin", "lon_bin")


def by_satellite(df: DataFrame) -> DataFrame:
    return counts_by(df, "satellite").orderBy(F.desc("n"), "satellite")


def share_of_total(counts: DataFrame, n: str = "n", out: str = "pct") -> DataFrame:
    """Percentage of the sum of ``n``; the sum is one number, read as a scalar subquery."""
    total = counts.agg(F.sum(n).alias("total")).scalar()
    return counts.withColumn(out, 100.0 * F.col(n) / total)


def confidence_distribution(df: DataFrame) -> DataFrame:
    return share_of_total(counts_by(df, "confidence")).orderBy(F.desc("n"), "confidence")


def class_balance(df: DataFrame, target: str = TARGET, by: str | None = None) -> DataFrame:
    """Rows and share of every class, of the whole table or within each value of ``by``."""
    if by is None:
        return share_of_total(counts_by(df, target)).orderBy(target)
    # One row per class of a group meets in the window.
    whole = F.sum("n").over(Window.partitionBy(by))
    return counts_by(df, by, target).withColumn("pct", 100.0 * F.col("n") / whole).orderBy(by, target)


def frp_stats(df: DataFrame, p95_method: str = "linear", approximate: bool = False) -> DataFrame:
    """Mean, median, sample deviation, 95th percentile and maximum of radiative power.

    The quantiles are exact. All five numbers come from the counts per distinct value, so the table
    is read once; ``approximate`` takes a fixed-size sketch over the rows instead.
    """
    if approximate:
        sketch = F.percentile_approx("frp", [0.5, 0.95], 10000)
        return df.agg(
            F.avg("frp").alias("mean"),
            sketch[0].alias("median"),
            F.stddev_samp("frp").alias("std"),
            sketch[1].alias("p95"),
            F.max("frp").alias("max"),
        )
    counts = value_counts(df, "frp")
    ranked = running_totals(counts, "value", ["n"])
    center = counts.agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("center")).scalar()
    off = F.col("value") - center
    return ranked.agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        quantile_column(0.5).alias("median"),
        F.sqrt(F.try_divide(F.sum(off * off * F.col("n")), F.sum("n") - 1)).alias("std"),
        quantile_column(0.95, p95_method).alias("p95"),
        F.max("value").alias("max"),
    )


def clip_upper(df: DataFrame, col: str = "frp", q: float = 0.99) -> DataFrame:
    """Cap a column at its own exact quantile; nulls stay null."""
    cap = exact_quantiles(df, col, {"cap": q}).scalar()
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.least(F.col(col), cap)))


def contrast_by_confidence(df: DataFrame) -> DataFrame:
    return (
        with_delta_t(df)
        .groupBy("confidence")
        .agg(F.avg("delta_t").alias("mean_delta_t"), F.avg("frp").alias("mean_frp"), rows_counted())
        .orderBy("confidence")
    )


def satellite_month(df: DataFrame) -> DataFrame:
    """Count and mean power by satellite and month, or by whichever of the two exists."""
    dated = with_month(df) if has(df, "acq_date") else df
    keys = [k for k in ("satellite", "month") if k in dated.columns and (k != "month" or has(df, "acq_date"))]
    return dated.groupBy(*keys).agg(rows_counted(), F.avg("frp").alias("mean_frp"))


def merged_moments(x: dict, y: dict) -> dict:
    """Co-moments of two disjoint sets of rows together: counts, means and centred sums, of numbers or arrays alike."""
    n = x["n"] + y["n"]
    share = y["n"] / np.maximum(n, 1)
    da, db = y["ma"] - x["ma"], y["mb"] - x["mb"]
    weight = x["n"] * share
    return {
        "n": n, "ma": x["ma"] + da * share, "mb": x["mb"] + db * share,
        "aa": x["aa"] + y["aa"] + da * da * weight, "bb": x["bb"] + y["bb"] + db * db * weight,
        "ab": x["ab"] + y["ab"] + da * db * weight,
    }


def batch_moments(table: np.ndarray) -> dict:
    """Co-moments of all pairs of columns (arrays columns x columns) over the rows where both are known."""
    known = ~np.isnan(table)
    one = known.astype(float)
    counts = known.sum(0)
    centre = np.where(known, table, 0).sum(0) / np.maximum(counts, 1)
    y = np.where(known, table - centre, 0)
    n, sums, squares = one.T @ one, y.T @ one, (y * y).T @ one  # [a, b]: of a, where b is known too
    mean = sums / np.maximum(n, 1)
    spread = np.maximum(squares - sums * mean, 0)
    at = np.where(n > 0, centre[:, None] + mean, 0)
    return {"n": n, "ma": at, "mb": at.T, "aa": spread, "bb": spread.T, "ab": y.T @ y - sums * mean.T}


def moment_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            table = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1)
            found = batch_moments(table)
            whole = found if whole is None else merged_moments(whole, found)
        if whole is not None:
            a, b = np.triu_indices(size)
            columns = {"a": a.astype(np.int32), "b": b.astype(np.int32), **{k: v[a, b].astype(float) for k, v in whole.items()}}
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))

    return rows


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs in long form, over the whole table in one scan.

    Centred co-moments (count, means, sums of products) are taken per task by matrix products, for pairs a <= b, and
    merged pairwise; a task sends one small row per pair. A pair uses the rows where both values are known; NaN
    counts as unknown. ``r`` is null where one column is constant, and 1 for any other column with itself.
    """
    cols = list(cols) if cols is not None else numeric_predictors(df)
    known = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{k}") for k, c in enumerate(cols)])
    names = ["n", "ma", "mb", "aa", "bb", "ab"]
    tasks = known.mapInArrow(moment_rows(len(cols)), "a int, b int, " + ", ".join(f"{c} double" for c in names))

    def together(x: Column, y: Column) -> Column:
        n = x["n"] + y["n"]
        share = F.when(n > 0, y["n"] / n).otherwise(0.0)
        da, db, weight = y["ma"] - x["ma"], y["mb"] - x["mb"], x["n"] * share
        values = (
            n, x["ma"] + da * share, x["mb"] + db * share, x["aa"] + y["aa"] + da * da * weight,
            x["bb"] + y["bb"] + db * db * weight, x["ab"] + y["ab"] + da * db * weight,
        )
        return F.struct(*[v.alias(c) for v, c in zip(values, names, strict=True)])

    nothing = F.struct(*[F.lit(0.0).alias(c) for c in names])
    whole = tasks.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("s"))  # a row per task
    m = whole.select("a", "b", F.aggregate("s", nothing, together).alias("m"))
    # What is left of a constant column is rounding.
    varies = F.lit(True)
    for side in "ab":
        varies &= F.col(f"m.{side}{side}") > 1e-26 * F.col("m.n") * F.col(f"m.m{side}") * F.col(f"m.m{side}")
    shared = F.col("m.ab") / (F.sqrt("m.aa") * F.sqrt("m.bb"))
    r = F.when(varies, F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), shared))))
    named = F.array(*[F.lit(c) for c in cols])
    pair = lambda x, y: F.struct(named[F.col(x)].alias("a"), named[F.col(y)].alias("b"), F.col("r"))
    both = F.when(F.col("a") == F.col("b"), F.array(pair("a", "b"))).otherwise(F.array(pair("a", "b"), pair("b", "a")))
    found = m.select("a", "b", r.alias("r")).select(F.inline(both))
    # A table without rows has no task that says so.
    every = df.sparkSession.createDataFrame([(a, b) for a in cols for b in cols], "a string, b string")
    return every.join(found, ["a", "b"], "left")


def histogram(df: DataFrame, col: str, bins: int = 80, clip_q: float | None = None) -> DataFrame:
    """Counts in equal bins between the smallest and the largest value, empty bins included.

    The last bin is closed. ``clip_q`` caps the values at that exact quantile first.
    """
    values = df.select(F.col(col).cast("double").alias("value")).where("value IS NOT NULL AND NOT isnan(value)")
    if clip_q is not None:
        values = clip_upper(values, "value", clip_q)
    limits = values.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high")).alias("limits")).scalar()
    placed = values.withColumn("_limits", limits).select(
        _bin_of(F.col("value"), F.col("_limits.low"), F.col("_limits.high"), bins).alias("bin")
    )
    counted = placed.groupBy("bin").agg(rows_counted())
    domain = (
        df.sparkSession.range(1, bins + 1)
        .select(F.col("id").cast("int").alias("bin"))
        .withColumn("_limits", limits)
    )
    low, high = F.col("_limits.low"), F.col("_limits.high")
    wide = F.when(high > low, high - low).otherwise(F.lit(1.0))
    start = F.when(high > low, low).otherwise(low - 0.5)
    return domain.join(counted, "bin", "left").select(
        "bin",
        (start + wide * (F.col("bin") - 1) / bins).alias("bin_low"),
        (start + wide * F.col("bin") / bins).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """A single value in the table gets a bin of width one around it, as its middle."""
    spread = F.width_bucket(value, low, high, F.lit(bins))
    middle = F.lit(bins // 2 + 1)
    return F.when(high > low, F.least(spread, F.lit(bins))).otherwise(middle).cast("int")


def peak_days(df: DataFrame, k: int = 3) -> DataFrame:
    return counts_by(df, "acq_date").orderBy(F.desc("n"), "acq_date").limit(k)


def top_cells(df: DataFrame, k: int = 5, decimals: int = 0) -> DataFrame:
    return grid_density(df, decimals).orderBy(F.desc("n"), "lat_bin", "lon_bin").limit(k)


def distinct_pairs(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


