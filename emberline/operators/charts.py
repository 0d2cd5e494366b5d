"""Tables behind the charts: each returns exactly the rows a chart draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from emberline.functions.runs import with_device
from emberline.operators.filters import runs_of
from emberline.operators.run_reports import (
    CHARTED,
    SIZES,
    append_model,
    complete_domain,
    device_speedup,
    melt_metrics,
    scaling_index,
)


def speedup_series(runs: DataFrame, order: str = "run_id") -> DataFrame:
    return complete_domain(device_speedup(runs, order), ["model"])


def throughput_series(runs: DataFrame, order: str = "run_id") -> DataFrame:
    """Rows per second of the first run per model, device and size."""
    firsts = with_device(runs).groupBy("model", "device", "dataset_pct").agg(
        F.min_by("throughput_rows_s", order).alias("throughput_rows_s")
    )
    return complete_domain(firsts, ["model", "device"])


def times_at(runs: DataFrame, size: str, order: str = "run_id") -> DataFrame:
    """Seconds per model at one size, one column per device, one decimal."""
    rows = with_device(runs.where(F.col("dataset_pct") == size))
    wide = rows.groupBy("model").pivot("device", ["CPU", "GPU"]).agg(F.min_by("time_s", order))
    return wide.select("model", F.round("CPU", 1).alias("cpu_s"), F.round("GPU", 1).alias("gpu_s"))


def resources_at(runs: DataFrame, size: str, metric: str) -> DataFrame:
    """One bar per run: memory or use at one size, labelled by model and device."""
    rows = with_device(runs.where(F.col("dataset_pct") == size))
    return rows.select(
        F.concat_ws(" · ", "model", "device").alias("label"), F.round(metric, 1).alias(metric)
    )


def scaling_series(runs: DataFrame, order: str = "run_id") -> DataFrame:
    return complete_domain(scaling_index(runs, order=order), ["model", "device"], SIZES[1:])


def quality_by(metrics: DataFrame, image_metrics: DataFrame, metric: str) -> DataFrame:
    return append_model(metrics, image_metrics, metric).select("model", metric)


def quality_profile(metrics: DataFrame) -> DataFrame:
    return melt_metrics(metrics, ("precision", "recall", "f1", "roc_auc"))


def ideal_speedup(report: DataFrame, backends: Sequence[str] = CHARTED) -> DataFrame:
    """The line S(p) = p up to the largest thread count of each operation."""
    largest = runs_of(report, "strong", backends).groupBy("operation").agg(F.max("threads").alias("_largest"))
    line = largest.select("operation", F.explode(F.sequence(F.lit(1), "_largest")).alias("threads"))
    return line.withColumn("speedup", F.col("threads").cast("double"))


def strong_scaling_series(report: DataFrame, operation: str, backends: Sequence[str] = CHARTED) -> DataFrame:
    return (
        runs_of(report, "strong", backends)
        .where(F.col("operation") == operation)
        .select("backend", "threads", "frac", "parallel_speedup")
        .orderBy("backend", "threads", "frac")
    )
