"""Queries over benchmark runs, device runs, model metrics and search runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions.runs import clean_model_name, with_config_values, with_device
from emberline.operators import charts, filters, profile, run_reports
from emberline.registry import views
from emberline.registry.book import register
from emberline.registry.detection_queries import rounded, typed
from emberline.registry.views import sql_with
from emberline.schemas import PREDICTORS, TARGET


def on(source: Callable, work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(source(spark, sf_dir))


def on_runs(work):
    return on(views.bench_runs, work)


def on_report(work):
    return on(views.bench_runs, lambda runs: work(run_reports.speedup_report(runs)))


def on_devices(work):
    return on(views.device_runs, work)


# ---- columns and filters ------------------------------------------------------------------------

register(
    "with_device",
    "P12",
    on_devices(lambda d: with_device(d).select("run_id", "backend", "device")),
    sql_with("dev", "SELECT run_id, backend, device FROM dev"),
)
register(
    "clean_model_name",
    "P13",
    lambda spark, sf_dir: clean_model_name(
        views.table(spark, sf_dir, "events").selectExpr("event_id", f"{views.DEVICE_RUNS['model']} AS model")
    ),
    "SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'Random Forest' WHEN 1 THEN 'Boosted Trees' ELSE 'Neural Network' END "
    "AS model FROM events",
)
register(
    "with_throughput",
    "P14",
    on_runs(lambda d: rounded(d, 6, "throughput_rows_s", "throughput_mb_s").select(
        "repetition", "throughput_rows_s", "throughput_mb_s")),
    sql_with(
        "runs",
        "SELECT repetition, round(throughput_rows_s, 6) AS throughput_rows_s, round(throughput_mb_s, 6) AS throughput_mb_s FROM runs",
    ),
)
CONFIG_NAMES = ("n_estimators", "max_depth", "eta", "batch_size", "lr")
register(
    "parse_config",
    "P15",
    on(views.search_runs, lambda d: with_config_values(d, CONFIG_NAMES).select("config", *CONFIG_NAMES)),
    sql_with(
        "sea",
        "SELECT config, "
        + ", ".join(
            f"CAST(nullif(regexp_extract(config, '{n}[^0-9]*([0-9.]+)', 1), '') AS DOUBLE) AS {n}" for n in CONFIG_NAMES
        )
        + " FROM sea",
    ),
)
register(
    "runs_of",
    "F6",
    on_runs(lambda d: filters.runs_of(d, "strong", ["polars", "dask"]).select("backend", "operation", "threads", "repetition")),
    sql_with(
        "runs",
        "SELECT backend, operation, threads, repetition FROM runs WHERE regime = 'strong' AND backend IN ('polars', 'dask')",
    ),
)

# ---- summary, speedups, efficiency --------------------------------------------------------------

SUMMARY = ("time_s", "min_time_s", "max_time_s", "rows", "throughput_rows_s", "throughput_mb_s", "peak_mem_mb")
CONFIG = ", ".join(run_reports.CONFIG)
register(
    "summarise_runs",
    "A16",
    on_runs(lambda d: rounded(run_reports.summarise_runs(d), 6, *SUMMARY)),
    sql_with("summ", f"SELECT {CONFIG}, {', '.join(f'round({c}, 6) AS {c}' for c in SUMMARY)}, n_runs FROM summ"),
)
register(
    "global_speedup",
    "J1 W4",
    on_runs(
        lambda d: rounded(run_reports.global_speedup(run_reports.summarise_runs(d)), 6, "global_speedup").select(
            *run_reports.CONFIG, "global_speedup", "baseline_used"
        )
    ),
    sql_with("rep", f"SELECT {CONFIG}, round(global_speedup, 6) AS global_speedup, baseline_used FROM rep"),
)
register(
    "global_speedup_fallback",
    "J1",
    on_runs(
        lambda d: rounded(
            run_reports.global_speedup(run_reports.summarise_runs(d), baseline="an engine without runs"), 6, "global_speedup"
        ).select(*run_reports.CONFIG, "global_speedup", "baseline_used")
    ),
    sql_with(
        "rep",
        f"SELECT {CONFIG}, CASE WHEN regime = 'strong' THEN round(other / time_s, 6) END AS global_speedup, "
        "CASE WHEN other IS NULL THEN '' ELSE 'polars-1thread' END AS baseline_used "
        "FROM summ LEFT JOIN (SELECT operation AS op, other FROM base) ON operation = op",
    ),
)
register(
    "parallel_speedup",
    "J2 W4",
    on_runs(
        lambda d: rounded(run_reports.parallel_speedup(run_reports.summarise_runs(d)), 6, "parallel_speedup").select(
            *run_reports.CONFIG, "parallel_speedup"
        )
    ),
    sql_with("rep", f"SELECT {CONFIG}, round(parallel_speedup, 6) AS parallel_speedup FROM rep"),
)
register(
    "efficiency",
    "A17",
    on_report(lambda r: rounded(r, 6, "efficiency").select(*run_reports.CONFIG, "efficiency")),
    sql_with("rep", f"SELECT {CONFIG}, round(efficiency, 6) AS efficiency FROM rep"),
)
CHARTED = "regime = 'strong' AND backend IN ('polars', 'dask')"
register(
    "mean_efficiency_by_threads",
    "A18",
    on_report(lambda r: rounded(run_reports.mean_efficiency_by_threads(r), 6, "mean_efficiency")),
    sql_with(
        "rep",
        f"SELECT backend, threads, round(avg(efficiency), 6) AS mean_efficiency FROM rep WHERE {CHARTED} GROUP BY ALL",
    ),
)
register(
    "mean_throughput_by_threads",
    "A19",
    on_report(lambda r: rounded(run_reports.mean_throughput_by_threads(r), 9, "mean_million_rows_s")),
    sql_with(
        "rep",
        "SELECT backend, threads, round(avg(throughput_rows_s) / 1e6, 9) AS mean_million_rows_s "
        f"FROM rep WHERE {CHARTED} GROUP BY ALL",
    ),
)
register(
    "best_time",
    "A20",
    on_report(
        lambda r: rounded(run_reports.best_time(r), 6, "best_time_s")
    ),
    sql_with(
        "summ",
        "SELECT backend, operation, round(coalesce(min(time_s), 0), 6) AS best_time_s FROM (SELECT DISTINCT backend FROM sub) "
        "CROSS JOIN (SELECT DISTINCT operation FROM sub) LEFT JOIN sub USING (backend, operation) GROUP BY ALL",
        sub="SELECT * FROM summ WHERE regime = 'strong'",
    ),
)
register(
    "peak_memory",
    "A21",
    on_report(run_reports.peak_memory),
    sql_with("summ", "SELECT backend, max(peak_mem_mb) AS peak_mem_mb FROM summ WHERE regime = 'strong' GROUP BY backend"),
)
BEST = ("backend", "operation", "threads", "frac")
PAR = "regime = 'strong' AND backend IN ('polars', 'dask', 'cudf')"
for _metric in ("global_speedup", "parallel_speedup"):
    register(
        f"best_{_metric}",
        "A22",
        on_report(
            lambda r, m=_metric: rounded(
                run_reports.best_run(filters.runs_of(r, "strong", run_reports.PARALLEL), m, run_reports.CONFIG), 6, m
            ).select(*BEST, m)
        ),
        sql_with(
            "rep",
            f"SELECT {', '.join(BEST)}, round({_metric}, 6) AS {_metric} FROM rep WHERE {PAR} AND {_metric} IS NOT NULL "
            f"ORDER BY rep.{_metric} DESC, {CONFIG} LIMIT 1",
        ),
    )
register(
    "saturation",
    "A23",
    on_report(lambda r: rounded(run_reports.saturation(r), 6, "mean_efficiency")),
    sql_with(
        "rep",
        "SELECT backend, threads, round(avg(efficiency), 6) AS mean_efficiency, avg(efficiency) < 0.5 AS saturated "
        f"FROM rep JOIN (SELECT backend AS b, max(threads) AS t FROM rep WHERE {CHARTED} GROUP BY 1) ON backend = b AND threads = t "
        f"WHERE {CHARTED} GROUP BY ALL",
    ),
)
register(
    "weak_scaling",
    "A24",
    on_report(lambda r: rounded(run_reports.weak_scaling(r), 6, "time_s")),
    sql_with(
        "summ",
        "SELECT operation, threads, backend, frac, round(time_s, 6) AS time_s FROM summ WHERE regime = 'weak'",
    ),
)
register(
    "distinct_pairs",
    "A33",
    on_runs(lambda d: profile.distinct_pairs(filters.runs_of(d, "strong"), "operation", "backend")),
    sql_with("runs", "SELECT DISTINCT operation, backend FROM runs WHERE regime = 'strong'"),
)
SHOWN = ("time_s", "global_speedup", "parallel_speedup", "efficiency", "throughput_rows_s", "throughput_mb_s", "peak_mem_mb")
register(
    "summary_table",
    "O3",
    on_report(run_reports.summary_table),
    sql_with("rep", f"SELECT {CONFIG}, {', '.join(f'round({c}, 4) AS {c}' for c in SHOWN)}, n_runs FROM rep"),
)
register(
    "ideal_speedup",
    "D8",
    on_runs(charts.ideal_speedup),
    sql_with(
        "runs",
        "SELECT operation, CAST(p AS INTEGER) AS threads, CAST(p AS DOUBLE) AS speedup FROM "
        f"(SELECT operation, max(threads) AS m FROM runs WHERE {CHARTED} GROUP BY 1), generate_series(1, 16) AS s(p) WHERE p <= m",
    ),
)
register(
    "strong_scaling_series",
    "D9",
    on_report(lambda r: rounded(charts.strong_scaling_series(r, "aggregate"), 6, "parallel_speedup")),
    sql_with(
        "rep",
        "SELECT backend, threads, frac, round(parallel_speedup, 6) AS parallel_speedup FROM rep "
        f"WHERE {CHARTED} AND operation = 'aggregate'",
    ),
)

# ---- device runs ----------------------------------------------------------------------------------

register(
    "device_speedup",
    "J3 W4",
    on_devices(lambda d: rounded(run_reports.device_speedup(d), 6, "speedup")),
    sql_with("spd", "SELECT model, dataset_pct, round(speedup, 6) AS speedup FROM spd"),
)
register(
    "scaling_index",
    "J4 W4",
    on_devices(lambda d: rounded(run_reports.scaling_index(d), 6, "scaling_index")),
    sql_with("scal", "SELECT model, device, dataset_pct, round(scaling_index, 6) AS scaling_index FROM scal"),
)
GRID = "(SELECT unnest(['30%', '60%', '100%']) AS dataset_pct)"
register(
    "complete_domain",
    "J5",
    on_devices(
        lambda d: rounded(
            run_reports.complete_domain(run_reports.device_speedup(d), ["model"]), 6, "speedup"
        )
    ),
    sql_with(
        "spd",
        "SELECT m.model, g.dataset_pct, round(speedup, 6) AS speedup FROM (SELECT DISTINCT model FROM spd) m "
        f"CROSS JOIN {GRID} g LEFT JOIN spd ON spd.model = m.model AND spd.dataset_pct = g.dataset_pct",
    ),
)
register(
    "pivot_devices",
    "U4",
    on_devices(run_reports.pivot_devices),
    sql_with(
        "dev",
        'SELECT model, dataset_pct, first(time_s ORDER BY run_id) FILTER (device = \'CPU\') AS "CPU", '
        'first(time_s ORDER BY run_id) FILTER (device = \'GPU\') AS "GPU" FROM dev GROUP BY ALL',
    ),
)
register(
    "speedup_series",
    "D1",
    on_devices(lambda d: rounded(charts.speedup_series(d), 6, "speedup")),
    sql_with(
        "spd",
        "SELECT m.model, g.dataset_pct, round(speedup, 6) AS speedup FROM (SELECT DISTINCT model FROM spd) m "
        f"CROSS JOIN {GRID} g LEFT JOIN spd ON spd.model = m.model AND spd.dataset_pct = g.dataset_pct",
    ),
)
register(
    "throughput_series",
    "D2",
    on_devices(lambda d: rounded(charts.throughput_series(d), 6, "throughput_rows_s")),
    sql_with(
        "dev",
        "SELECT model, device, dataset_pct, round(first(throughput_rows_s ORDER BY run_id), 6) AS throughput_rows_s "
        "FROM dev GROUP BY ALL",
    ),
)
register(
    "times_at",
    "D3",
    on_devices(lambda d: charts.times_at(d, "100%")),
    sql_with(
        "dev",
        "SELECT model, round(first(time_s ORDER BY run_id) FILTER (device = 'CPU'), 1) AS cpu_s, "
        "round(first(time_s ORDER BY run_id) FILTER (device = 'GPU'), 1) AS gpu_s "
        "FROM dev WHERE dataset_pct = '100%' GROUP BY model",
    ),
)
register(
    "resources_at",
    "D4",
    on_devices(lambda d: charts.resources_at(d, "60%", "gpu_util_avg_pct")),
    sql_with(
        "dev",
        "SELECT concat(model, ' · ', device) AS label, round(gpu_util_avg_pct, 1) AS gpu_util_avg_pct "
        "FROM dev WHERE dataset_pct = '60%'",
    ),
)
register(
    "scaling_series",
    "D5",
    on_devices(lambda d: rounded(charts.scaling_series(d), 6, "scaling_index")),
    sql_with("scal", "SELECT model, device, dataset_pct, round(scaling_index, 6) AS scaling_index FROM scal"),
)

# ---- model metrics and search -----------------------------------------------------------------------

QUALITY = ("accuracy", "precision", "recall", "f1", "roc_auc")


def on_metrics(work):
    return on(views.model_metrics, work)


def with_images(work):
    return lambda spark, sf_dir: work(views.model_metrics(spark, sf_dir), views.image_metrics(spark, sf_dir))


register(
    "append_model",
    "U2",
    with_images(lambda m, i: run_reports.append_model(m, i, "f1")),
    sql_with("met img", "SELECT * FROM met UNION ALL SELECT *, NULL, NULL FROM img"),
)
MELT = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM met" for m in QUALITY)
register("melt_metrics", "U3", on_metrics(run_reports.melt_metrics), sql_with("met", MELT))
register(
    "quality_by",
    "D6",
    with_images(lambda m, i: charts.quality_by(m, i, "roc_auc")),
    sql_with("met img", "SELECT model, roc_auc FROM met UNION ALL SELECT model, roc_auc FROM img"),
)
register(
    "quality_profile",
    "D7",
    on_metrics(charts.quality_profile),
    sql_with("met", f"SELECT * FROM ({MELT}) WHERE metric <> 'accuracy'"),
)
register(
    "best_model_by_f1",
    "A22",
    on_metrics(lambda m: run_reports.best_run(m, "f1", ["model"]).select("model", "f1", "roc_auc")),
    sql_with("met", "SELECT model, f1, roc_auc FROM met ORDER BY f1 DESC, model LIMIT 1"),
)
register(
    "fastest_model",
    "A22",
    on_metrics(lambda m: run_reports.best_run(m, "train_time_s", ["model"], largest=False).select("model", "train_time_s")),
    sql_with("met", "SELECT model, train_time_s FROM met ORDER BY train_time_s, model LIMIT 1"),
)
register(
    "fastest_within_tolerance",
    "W1",
    on(views.search_runs, lambda d: rounded(run_reports.fastest_within_tolerance(d), 9, "given_up")),
    sql_with(
        "sea",
        "SELECT model, config, f1, time_s, best, round(best - f1, 9) AS given_up FROM (SELECT *, row_number() OVER "
        "(PARTITION BY model ORDER BY time_s, config, f1 DESC) AS r FROM (SELECT *, max(f1) OVER (PARTITION BY model) AS best "
        "FROM sea) WHERE f1 >= best - 0.01) WHERE r = 1",
    ),
)


def executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = run_reports.executive_summary(
        views.labelled(spark, sf_dir), views.model_metrics(spark, sf_dir), TARGET, len(PREDICTORS)
    )
    text = F.transform("balance", lambda c: F.format_string("%d:%d:%.6f", c["class"], c["n"], c["pct"]))
    return summary.withColumn("balance", F.array_join(text, " "))


register(
    "executive_summary",
    "A31",
    executive_summary,
    sql_with(
        "lab met",
        "SELECT (SELECT count(*) FROM lab) AS n_rows, 11 AS n_predictors, "
        "(SELECT string_agg(format('{:d}:{:d}:{:.6f}', c, n, 100.0::DOUBLE * n / (SELECT count(*) FROM lab)), ' ' ORDER BY c) "
        "FROM (SELECT is_false_alarm AS c, count(*) AS n FROM lab GROUP BY 1)) AS balance, "
        "(SELECT model FROM met ORDER BY f1 DESC, model LIMIT 1) AS best_model, "
        "(SELECT f1 FROM met ORDER BY f1 DESC, model LIMIT 1) AS best_f1, "
        "(SELECT roc_auc FROM met ORDER BY f1 DESC, model LIMIT 1) AS best_roc_auc, "
        "(SELECT model FROM met ORDER BY train_time_s, model LIMIT 1) AS fastest_model, "
        "(SELECT min(train_time_s) FROM met) AS fastest_time_s",
    ),
)
register(
    "kpis",
    "A32",
    lambda spark, sf_dir: rounded(
        run_reports.kpis(
            views.device_runs(spark, sf_dir), views.model_metrics(spark, sf_dir), views.image_metrics(spark, sf_dir)
        ),
        6,
        "value",
    ),
    sql_with(
        "spd met img",
        "(SELECT 'max_device_speedup' AS kpi, concat(model, ' · ', dataset_pct) AS detail, round(speedup, 6) AS value "
        "FROM spd ORDER BY speedup DESC, model, dataset_pct LIMIT 1) UNION ALL "
        "(SELECT 'best_tabular_f1', model, round(f1, 6) FROM met ORDER BY f1 DESC, model LIMIT 1) UNION ALL "
        "(SELECT 'image_model_f1', model, round(f1, 6) FROM img ORDER BY f1 DESC, model LIMIT 1)",
    ),
)
