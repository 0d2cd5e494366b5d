"""Benchmark runs: summary per configuration, speedups, efficiency, scaling.

Runs that failed were never written, so any configuration may be missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from emberline.functions.runs import with_device
from emberline.operators.filters import runs_of
from emberline.operators.ranking import null_safe_join, quantile_column, running_totals
from emberline.session import cut_lineage

# The sequential engine, the engine used in its place, and the parallel ones.
BASELINE = "pandas"
FALLBACK = "polars"
PARALLEL = ("polars", "dask", "cudf")
CHARTED = ("polars", "dask")

CONFIG = ("backend", "operation", "threads", "regime", "frac")
# Measures with a median, and the error of the sketch that brackets it: one row in so many.
MIDDLE = ("time_s", "rows", "throughput_rows_s", "throughput_mb_s")
SKETCH = 10_000


def summarise_runs(runs: DataFrame) -> DataFrame:
    """One row per configuration: exact medians, smallest and largest time, peak memory, run count.

    A sketch of fixed size brackets every median in one pass, beside the plain aggregates. The second pass counts what
    lies below and above the bracket as one value each and only the few values inside by themselves, so hardly a row is
    shuffled; these are laid out as (configuration, measure, value) and ranked in value ranges, so that a configuration
    with very many runs is spread over tasks like any other.
    """
    value = lambda m: F.col(m).cast("double")
    near = [0.5 - 2 / SKETCH, 0.5 + 2 / SKETCH]
    plain = runs.groupBy(*CONFIG).agg(
        F.min(value("time_s")).alias("min_time_s"),
        F.max(value("time_s")).alias("max_time_s"),
        F.max(value("peak_mem_mb")).alias("peak_mem_mb"),
        F.count("time_s").alias("n_runs"),
        *[F.percentile_approx(value(m), near, SKETCH).alias(f"_{m}") for m in MIDDLE],
    )
    bracketed = null_safe_join(runs.select(*CONFIG, *MIDDLE), plain.select(*CONFIG, *[f"_{m}" for m in MIDDLE]), CONFIG)

    def held(m: str) -> Column:
        low, high = F.col(f"_{m}")[0], F.col(f"_{m}")[1]
        return F.when(value(m) < low, float("-inf")).when(value(m) > high, float("inf")).otherwise(value(m))

    values = F.array(*[F.struct(F.lit(m).alias("measure"), held(m).alias("value")) for m in MIDDLE])
    laid_out = bracketed.select(*CONFIG, F.inline(values))
    counted = laid_out.where(F.col("value").isNotNull()).groupBy(*CONFIG, "measure", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = running_totals(counted, "value", ["n"], [*CONFIG, "measure"])
    middle = ranked.groupBy(*CONFIG, "measure").agg(quantile_column(0.5).alias("median"))
    medians = middle.groupBy(*CONFIG).agg(*[F.max(F.when(F.col("measure") == m, F.col("median"))).alias(m) for m in MIDDLE])
    return null_safe_join(plain.select(*CONFIG, "min_time_s", "max_time_s", "peak_mem_mb", "n_runs"), medians, CONFIG, "left").select(
        *CONFIG, "time_s", "min_time_s", "max_time_s", *MIDDLE[1:], "peak_mem_mb", "n_runs"
    )


def first_match(value: Column, when: Column, *order: str) -> Column:
    """Aggregate: the value of the first row, by ``order``, among those where ``when`` holds."""
    return F.min_by(value, F.when(when, F.struct(*order)))


def global_speedup(summary: DataFrame, baseline: str = BASELINE, fallback: str = FALLBACK) -> DataFrame:
    """Sequential time over own time, per operation; the fallback engine on one thread stands in.

    Null outside the strong regime and for times that are not positive. ``baseline_used`` is given for
    every row of an operation that has a baseline.
    """
    main = F.col("backend") == baseline
    other = (F.col("backend") == fallback) & (F.col("threads") == 1)
    bases = runs_of(summary, "strong").groupBy("operation").agg(
        first_match(F.col("time_s"), main, "threads", "frac").alias("_main"),
        F.max(main).alias("_has_main"),
        first_match(F.col("time_s"), other, "threads", "frac").alias("_other"),
        F.max(other).alias("_has_other"),
    )
    base = F.when(F.col("_has_main"), F.col("_main")).when(F.col("_has_other"), F.col("_other"))
    used = F.when(F.col("_has_main"), f"{baseline}-1thread").when(F.col("_has_other"), f"{fallback}-1thread")
    timed = (F.col("regime") == "strong") & (F.col("time_s") > 0)
    return null_safe_join(summary, bases, ["operation"], "left").select(
        *summary.columns,
        F.when(timed, base / F.col("time_s")).alias("global_speedup"),
        F.coalesce(used, F.lit("")).alias("baseline_used"),
    )


def parallel_speedup(summary: DataFrame) -> DataFrame:
    """Own time on one thread over own time, per operation and backend; null without such a time."""
    single = F.col("threads") == 1
    bases = runs_of(summary, "strong").groupBy("operation", "backend").agg(
        first_match(F.col("time_s"), single, "frac").alias("_single")
    )
    timed = (F.col("regime") == "strong") & (F.col("time_s") > 0) & (F.col("_single") != 0)
    return null_safe_join(summary, bases, ["operation", "backend"], "left").select(
        *summary.columns, F.when(timed, F.col("_single") / F.col("time_s")).alias("parallel_speedup")
    )


def with_efficiency(df: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """Parallel speedup per thread, for the parallel engines in the strong regime."""
    counted = (F.col("regime") == "strong") & (F.col("threads") > 0) & (F.col("backend") != baseline)
    return df.withColumn("efficiency", F.when(counted, F.col("parallel_speedup") / F.col("threads")))


def speedup_report(runs: DataFrame) -> DataFrame:
    """Summary with both speedups and the efficiency.

    The summary (a row per configuration) is computed once and kept in the shared folder, as the
    baselines are looked up in it.
    """
    summary = cut_lineage(summarise_runs(runs))
    return with_efficiency(parallel_speedup(global_speedup(summary)))


def mean_efficiency_by_threads(report: DataFrame, backends: Sequence[str] = CHARTED) -> DataFrame:
    return (
        runs_of(report, "strong", backends)
        .groupBy("backend", "threads")
        .agg(F.avg("efficiency").alias("mean_efficiency"))
        .orderBy("backend", "threads")
    )


def mean_throughput_by_threads(report: DataFrame, backends: Sequence[str] = CHARTED) -> DataFrame:
    return (
        runs_of(report, "strong", backends)
        .groupBy("backend", "threads")
        .agg((F.avg("throughput_rows_s") / 1e6).alias("mean_million_rows_s"))
        .orderBy("backend", "threads")
    )


def best_time(report: DataFrame) -> DataFrame:
    """Least time by backend and operation in the strong regime; pairs without a run give zero.

    The result has one row per backend and operation, so the list of operations (a short set of
    names) is smaller than the result.
    """
    strong = runs_of(report, "strong").where(F.col("backend").isNotNull() & F.col("operation").isNotNull())
    least = strong.groupBy("backend", "operation").agg(F.min("time_s").alias("_least"))
    operations = least.agg(F.collect_set("operation").alias("operations")).scalar()
    pairs = (
        least.select("backend")
        .distinct()
        .withColumn("_operations", operations)
        .select("backend", F.explode("_operations").alias("operation"))
    )
    return pairs.join(least, ["backend", "operation"], "left").select(
        "backend", "operation", F.coalesce("_least", F.lit(0.0)).alias("best_time_s")
    )


def peak_memory(report: DataFrame) -> DataFrame:
    return runs_of(report, "strong").groupBy("backend").agg(F.max("peak_mem_mb").alias("peak_mem_mb"))


def best_run(df: DataFrame, metric: str, ties: Sequence[str], largest: bool = True) -> DataFrame:
    """The row with the largest (or smallest) known metric; ties go to the first by ``ties``."""
    order = F.desc(metric) if largest else F.asc(metric)
    return df.where(F.col(metric).isNotNull()).orderBy(order, *ties).limit(1)


def saturation(report: DataFrame, backends: Sequence[str] = CHARTED, limit: float = 0.5) -> DataFrame:
    """Mean efficiency at the largest thread count of each backend, and whether it is low."""
    by_threads = runs_of(report, "strong", backends).groupBy("backend", "threads").agg(
        F.avg("efficiency").alias("_mean")
    )
    return (
        by_threads.groupBy("backend")
        .agg(F.max("threads").alias("threads"), F.max_by("_mean", "threads").alias("mean_efficiency"))
        .where(F.col("mean_efficiency").isNotNull())
        .withColumn("saturated", F.col("mean_efficiency") < limit)
    )


def weak_scaling(report: DataFrame) -> DataFrame:
    return (
        runs_of(report, "weak")
        .select("operation", "threads", "backend", "frac", "time_s")
        .orderBy("operation", "threads", "backend", "frac")
    )


def summary_table(report: DataFrame, digits: int = 4) -> DataFrame:
    shown = [
        "time_s",
        "global_speedup",
        "parallel_speedup",
        "efficiency",
        "throughput_rows_s",
        "throughput_mb_s",
        "peak_mem_mb",
    ]
    return report.select(*CONFIG, *[F.round(c, digits).alias(c) for c in shown], "n_runs").orderBy(
        "regime", "operation", "backend", "threads", "frac"
    )


# ---- training runs on CPU and GPU ------------------------------------------------------------

# Dataset sizes of the training runs; the first is the base of the scaling index.
SIZES = ("30%", "60%", "100%")


def device_speedup(runs: DataFrame, order: str = "run_id") -> DataFrame:
    """CPU time over GPU time per model and size; pairs without both are left out, GPU time 0 gives null."""
    cpu, gpu = F.col("device") == "CPU", F.col("device") == "GPU"
    sides = with_device(runs).groupBy("model", "dataset_pct").agg(
        first_match(F.col("time_s"), cpu, order).alias("_cpu"),
        first_match(F.col("time_s"), gpu, order).alias("_gpu"),
        F.count_if(cpu).alias("_n_cpu"),
        F.count_if(gpu).alias("_n_gpu"),
    )
    return sides.where((F.col("_n_cpu") > 0) & (F.col("_n_gpu") > 0)).select(
        "model", "dataset_pct", F.when(F.col("_gpu") != 0, F.col("_cpu") / F.col("_gpu")).alias("speedup")
    )


def scaling_index(runs: DataFrame, base: str = SIZES[0], order: str = "run_id") -> DataFrame:
    """Growth of time over growth of rows against the base size, per model and device.

    The row count of the first base run counts for all models. Runs without a base run are left out.
    """
    marked = with_device(runs)
    at_base = marked.where(F.col("dataset_pct") == base)
    times = at_base.groupBy("model", "device").agg(F.min_by("time_s", order).alias("_base_time"))
    rows = at_base.agg(F.min_by("train_rows", order).alias("_base_rows")).scalar()
    larger = marked.where(F.col("dataset_pct").isin(*[s for s in SIZES if s != base]))
    index = (F.col("time_s") / F.col("_base_time")) / (F.col("train_rows") / F.col("_base_rows"))
    return (
        larger.join(times, ["model", "device"])
        .withColumn("_base_rows", rows)
        .select("model", "device", "dataset_pct", index.alias("scaling_index"))
    )


def complete_domain(df: DataFrame, keys: Sequence[str], sizes: Sequence[str] = SIZES) -> DataFrame:
    """Every size for every key that occurs; absent values are null."""
    domain = df.select(*keys).distinct().withColumn("dataset_pct", F.explode(F.array(*[F.lit(s) for s in sizes])))
    return null_safe_join(domain, df, [*keys, "dataset_pct"], "left")


def pivot_devices(runs: DataFrame, order: str = "run_id") -> DataFrame:
    """Time of the first run per model and size, one column per device."""
    firsts = with_device(runs).groupBy("model", "dataset_pct").pivot("device", ["CPU", "GPU"])
    return firsts.agg(F.min_by("time_s", order))


# ---- hyper-parameter search and model comparison ------------------------------------------------


def fastest_within_tolerance(
    runs: DataFrame, tolerance: float = 0.01, quality: str = "f1", time: str = "time_s"
) -> DataFrame:
    """Per model the fastest configuration whose quality is at most ``tolerance`` below the best one.

    ``given_up`` is the quality lost by that choice. Equal times go to the first configuration text.
    """
    best = runs.groupBy("model").agg(F.max(quality).alias("best"))
    close = null_safe_join(runs, best, ["model"]).where(F.col(quality) >= F.col("best") - tolerance)
    order = F.struct(F.col(time), F.col("config"), -F.col(quality))
    return close.groupBy("model").agg(
        F.min_by("config", order).alias("config"),
        F.min_by(quality, order).alias(quality),
        F.min(time).alias(time),
        F.max("best").alias("best"),
        (F.max("best") - F.min_by(quality, order)).alias("given_up"),
    )


def append_model(metrics: DataFrame, extra: DataFrame, metric: str) -> DataFrame:
    """Add another model's row when it has the metric; columns it lacks are null."""
    if metric not in extra.columns:
        return metrics
    shared = [c for c in extra.columns if c in metrics.columns]
    known = extra.where(F.col(metric).isNotNull()).select(*shared)
    return metrics.unionByName(known, allowMissingColumns=True)


def melt_metrics(
    metrics: DataFrame, values: Sequence[str] = ("accuracy", "precision", "recall", "f1", "roc_auc")
) -> DataFrame:
    return metrics.unpivot("model", list(values), "metric", "value")


def executive_summary(model_table: DataFrame, metrics: DataFrame, target: str, n_predictors: int) -> DataFrame:
    """One row: table size, class balance, best model by F1 and the fastest one to train."""
    classes = model_table.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    # The target has a handful of classes.
    balance = classes.agg(
        F.sum("n").alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("class", "n"))).alias("_classes"),
    ).select(
        "n_rows",
        F.transform(
            "_classes",
            lambda c: F.struct(
                c["class"].alias("class"), c["n"].alias("n"), (100.0 * c["n"] / F.col("n_rows")).alias("pct")
            ),
        ).alias("balance"),
    )
    by_quality = F.struct(-F.col("f1"), F.col("model"))
    by_time = F.struct("train_time_s", "model")
    known = F.col("f1").isNotNull()
    picks = metrics.agg(
        F.min_by("model", F.when(known, by_quality)).alias("best_model"),
        F.min_by("f1", F.when(known, by_quality)).alias("best_f1"),
        F.min_by("roc_auc", F.when(known, by_quality)).alias("best_roc_auc"),
        F.min_by("model", F.when(F.col("train_time_s").isNotNull(), by_time)).alias("fastest_model"),
        F.min("train_time_s").alias("fastest_time_s"),
    )
    pick = picks.select(F.struct(*picks.columns).alias("pick")).scalar()
    return balance.withColumn("_pick", pick).select(
        "n_rows", F.lit(n_predictors).alias("n_predictors"), "balance", "_pick.*"
    )


def kpis(device_runs: DataFrame, metrics: DataFrame, image_metrics: DataFrame, order: str = "run_id") -> DataFrame:
    """Three figures: largest device speedup, best F1 on tables, F1 of the image model."""
    speedups = device_speedup(device_runs, order)
    largest = best_run(speedups, "speedup", ["model", "dataset_pct"]).select(
        F.lit("max_device_speedup").alias("kpi"),
        F.concat_ws(" · ", "model", "dataset_pct").alias("detail"),
        F.col("speedup").alias("value"),
    )
    best = best_run(metrics, "f1", ["model"]).select(
        F.lit("best_tabular_f1").alias("kpi"), F.col("model").alias("detail"), F.col("f1").alias("value")
    )
    image = best_run(image_metrics, "f1", ["model"]).select(
        F.lit("image_model_f1").alias("kpi"), F.col("model").alias("detail"), F.col("f1").alias("value")
    )
    return largest.unionByName(best).unionByName(image)
