import pytest
from pyspark.sql import functions as F

from emberline.operators import charts, run_reports as rr
from emberline.operators.profile import distinct_pairs
from emberline.schemas import MODEL_METRICS, TARGET

RUN = "backend string, operation string, threads int, regime string, frac double, time_s double, rows bigint, throughput_rows_s double, throughput_mb_s double, peak_mem_mb double"


def runs(spark, *rows):
    full = [(b, o, t, g, f, s, 100, 100 / s if s else 0.0, 1.0, m) for b, o, t, g, f, s, m in rows]
    return spark.createDataFrame(full, RUN)


@pytest.fixture
def report(spark):
    data = runs(
        spark,
        ("pandas", "aggregate", 1, "strong", 1.0, 8.0, 50.0),
        ("pandas", "aggregate", 1, "strong", 1.0, 12.0, 70.0),
        ("polars", "aggregate", 1, "strong", 1.0, 4.0, 10.0),
        ("polars", "aggregate", 2, "strong", 1.0, 2.0, 10.0),
        ("polars", "aggregate", 4, "strong", 1.0, 4.0, 10.0),
        ("polars", "filter", 1, "strong", 1.0, 6.0, 10.0),
        ("polars", "filter", 4, "strong", 1.0, 0.0, 10.0),
        ("dask", "aggregate", 2, "strong", 1.0, 5.0, 10.0),
        ("polars", "aggregate", 2, "weak", 0.5, 3.0, 10.0),
        ("dask", "load", 2, "strong", 1.0, 5.0, 10.0),
    )
    return rr.speedup_report(data)


def by_key(df):
    return {(r.backend, r.operation, r.threads, r.regime): r for r in df.collect()}


def test_summary_and_speedups(report):
    got = by_key(report)
    base = got["pandas", "aggregate", 1, "strong"]
    assert (base.time_s, base.min_time_s, base.max_time_s, base.n_runs, base.peak_mem_mb) == (10.0, 8.0, 12.0, 2, 70.0)
    assert base.global_speedup == 1.0 and base.parallel_speedup == 1.0 and base.efficiency is None
    two = got["polars", "aggregate", 2, "strong"]
    assert (two.global_speedup, two.parallel_speedup, two.efficiency) == (5.0, 2.0, 1.0)
    assert two.baseline_used == "pandas-1thread"


def test_missing_baselines(report):
    got = by_key(report)
    spare = got["polars", "filter", 1, "strong"]
    assert (spare.global_speedup, spare.baseline_used) == (1.0, "polars-1thread")
    instant = got["polars", "filter", 4, "strong"]
    assert instant.global_speedup is None and instant.parallel_speedup is None and instant.efficiency is None
    no_single = got["dask", "aggregate", 2, "strong"]
    assert no_single.parallel_speedup is None and no_single.efficiency is None and no_single.global_speedup == 2.0
    none = got["dask", "load", 2, "strong"]
    assert none.global_speedup is None and none.baseline_used == ""


def test_weak_rows_name_a_baseline_but_have_no_speedup(report):
    weak = by_key(report)["polars", "aggregate", 2, "weak"]
    assert (weak.global_speedup, weak.parallel_speedup, weak.baseline_used) == (None, None, "pandas-1thread")
    assert [tuple(r)[:2] for r in rr.weak_scaling(report).collect()] == [("aggregate", 2)]


def test_averages_and_extremes(report):
    eff = {(r.backend, r.threads): r.mean_efficiency for r in rr.mean_efficiency_by_threads(report).collect()}
    assert eff["polars", 2] == 1.0 and eff["polars", 4] == 0.25 and eff["dask", 2] is None
    sat = {r.backend: r for r in rr.saturation(report).collect()}
    assert set(sat) == {"polars"} and sat["polars"].threads == 4 and sat["polars"].saturated
    best = {(r.backend, r.operation): r.best_time_s for r in rr.best_time(report).collect()}
    assert best["polars", "aggregate"] == 2.0 and best["pandas", "filter"] == 0.0 and len(best) == 9
    assert {r.backend: r.peak_mem_mb for r in rr.peak_memory(report).collect()}["pandas"] == 70.0
    top = rr.best_run(report, "global_speedup", rr.CONFIG).first()
    assert (top.backend, top.threads) == ("polars", 2)
    assert distinct_pairs(report, "operation", "backend").count() == 5


def test_charts_of_runs(report):
    line = charts.ideal_speedup(report).where("operation = 'aggregate'").collect()
    assert [r.threads for r in line] == [1, 2, 3, 4] == [r.speedup for r in line]
    series = charts.strong_scaling_series(report, "aggregate").where("backend = 'polars'").collect()
    assert [(r.threads, r.parallel_speedup) for r in series] == [(1, 1.0), (2, 2.0), (4, 1.0)]


def test_many_runs_of_one_configuration(spark):
    data = spark.range(4001).select(
        F.when(F.col("id") % 3 == 0, "polars").otherwise("dask").alias("backend"),
        F.lit("load").alias("operation"),
        F.lit(1).alias("threads"),
        F.lit("strong").alias("regime"),
        F.lit(1.0).alias("frac"),
        (F.col("id") * 7 % 4001 + 1.0).alias("time_s"),
        F.lit(5).cast("bigint").alias("rows"),
        F.lit(1.0).alias("throughput_rows_s"),
        F.lit(1.0).alias("throughput_mb_s"),
        F.lit(1.0).alias("peak_mem_mb"),
    )
    want = {r.backend: tuple(r)[1:] for r in data.groupBy("backend").agg(F.median("time_s"), F.count("*")).collect()}
    got = {r.backend: (r.time_s, r.n_runs) for r in rr.summarise_runs(data).collect()}
    assert got == want


DEVICE = "run_id bigint, dataset_pct string, train_rows bigint, model string, backend string, time_s double, throughput_rows_s double, ram_peak_mb double"


@pytest.fixture
def devices(spark):
    data = [
        (1, "30%", 11_026_780, "RF", "CPU (x)", 685.682033, 1.0, 1.26),
        (2, "30%", 11_026_780, "RF", "GPU (cuML)", 107.294924, 2.0, 1.0),
        (3, "100%", 36_755_935, "RF", "CPU", 1582.563340, 3.0, 1.0),
        (4, "100%", 36_755_935, "RF", "GPU", 240.792246, 4.0, 1.0),
        (5, "100%", 36_755_935, "RF", "GPU", 1.0, 5.0, 1.0),
        (6, "100%", 36_755_935, "NN", "CPU", 15.172661, 6.0, 1.0),
        (7, "100%", 36_755_935, "NN", "cuda", 0.0, 7.0, 1.0),
        (8, "60%", 22_053_561, "XGB", "CPU", 3.0, 8.0, 1.0),
    ]
    return spark.createDataFrame(data, DEVICE)


def test_device_speedup(devices):
    got = {(r.model, r.dataset_pct): r.speedup for r in rr.device_speedup(devices).collect()}
    assert got["RF", "30%"] == pytest.approx(6.39, abs=0.005)
    assert got["RF", "100%"] == pytest.approx(6.57, abs=0.005)
    assert got["NN", "100%"] is None and ("XGB", "60%") not in got
    series = {(r.model, r.dataset_pct): r.speedup for r in charts.speedup_series(devices).collect()}
    assert series["RF", "60%"] is None and len(series) == 6


def test_scaling_index_uses_one_row_count(devices):
    got = {(r.model, r.device, r.scaling_index) for r in rr.scaling_index(devices).where("device = 'CPU'").collect()}
    assert len(got) == 1
    model, device, index = got.pop()
    assert model == "RF"
    assert index == pytest.approx((1582.563340 / 685.682033) / (36_755_935 / 11_026_780))


def test_device_charts(devices):
    wide = {(r.model, r.dataset_pct): (r.CPU, r.GPU) for r in rr.pivot_devices(devices).collect()}
    assert wide["RF", "100%"] == (1582.563340, 240.792246) and wide["XGB", "60%"] == (3.0, None)
    times = {r.model: (r.cpu_s, r.gpu_s) for r in charts.times_at(devices, "100%").collect()}
    assert times["RF"] == (1582.6, 240.8)
    bars = {r.label: r.ram_peak_mb for r in charts.resources_at(devices, "30%", "ram_peak_mb").collect()}
    assert bars == {"RF · CPU": 1.3, "RF · GPU": 1.0}
    assert charts.throughput_series(devices).count() == 5 * 3


def test_search_picks(spark):
    data = [
        ("RF", "{'n_estimators': 100, 'max_depth': 8}", 0.6231, 0.6430),
        ("RF", "{'n_estimators': 100, 'max_depth': 16}", 0.7700, 0.8404),
        ("RF", "{'n_estimators': 300, 'max_depth': 16}", 0.7704, 2.5296),
        ("RF", "{'n_estimators': 300, 'max_depth': 24}", 0.7697, 3.8690),
        ("XGB", "{'max_depth': 4, 'eta': 0.3}", 0.7951, 0.4353),
        ("XGB", "{'max_depth': 12, 'eta': 0.1}", 0.8032, 1.7889),
        ("NN", "{'batch_size': 2048, 'lr': 0.001}", 0.7415, 0.7317),
        ("NN", "{'batch_size': 32768, 'lr': 0.001}", 0.0, 0.0753),
        ("TIE", "b", 0.5, 1.0),
        ("TIE", "a", 0.495, 1.0),
    ]
    df = spark.createDataFrame(data, "model string, config string, f1 double, time_s double")
    got = {r.model: r for r in rr.fastest_within_tolerance(df).collect()}
    assert got["RF"].config == "{'n_estimators': 100, 'max_depth': 16}"
    assert got["RF"].given_up == pytest.approx(0.0004)
    assert got["XGB"].config == "{'max_depth': 4, 'eta': 0.3}"
    assert got["NN"].config == "{'batch_size': 2048, 'lr': 0.001}"
    assert got["TIE"].config == "a" and got["TIE"].best == 0.5


def test_image_model_joins_the_table(spark):
    metrics = spark.createDataFrame([("RF", 0.9, 0.7, 0.8, 0.75, 0.98, 100.0, 3.0, None, None, None)], MODEL_METRICS)
    image = spark.createDataFrame([("CNN", 0.96, "x")], "model string, f1 double, backend string")
    both = rr.append_model(metrics, image, "f1")
    assert both.columns == metrics.columns and both.count() == 2
    assert rr.append_model(metrics, image, "roc_auc").count() == 1
    assert [r.model for r in charts.quality_by(metrics, image, "f1").collect()] == ["RF", "CNN"]
    assert charts.quality_profile(metrics).count() == 4


def test_executive_summary(spark):
    metrics = spark.createDataFrame(
        [("A", 0.9, 0.7, 0.8, 0.75, 0.98, 100.0, 3.0, None, None, None), ("B", 0.9, 0.7, 0.8, 0.75, 0.5, 42.0, 3.0, None, None, None)],
        MODEL_METRICS,
    )
    table = spark.createDataFrame([(0,), (0,), (0,), (1,)], f"{TARGET} int")
    r = rr.executive_summary(table, metrics, TARGET, 11).first()
    assert (r.n_rows, r.n_predictors, r.best_model, r.best_roc_auc, r.fastest_model, r.fastest_time_s) == (4, 11, "A", 0.98, "B", 42.0)
    assert [(b["class"], b.n, b.pct) for b in r.balance] == [(0, 3, 75.0), (1, 1, 25.0)]


def test_throughput_of_a_run_of_no_time(spark, tmp_path):
    from pathlib import Path

    from emberline.registry.book import BOOK

    rows = [(0, 0, "click", 0.0), (3, 0, "click", 2.0), (1, 0, "click", 4.0), (2, 0, "click", None)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double").write.parquet(
        str(Path(tmp_path) / "events.parquet")
    )
    got = {r.dataset_pct: r.throughput_rows_s for r in BOOK["throughput_series"].query(spark, str(tmp_path)).collect()}
    assert got == {"30%": float("inf"), "60%": 600000 / 4.0, "100%": None}
