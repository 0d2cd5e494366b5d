import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from emberline.functions import features, runs
from emberline.functions.hashing import hash32
from emberline.schemas import MODEL_COLUMNS, MODEL_TABLE, PREDICTORS, TARGET


def test_label_is_exact_and_case_free(spark):
    df = spark.createDataFrame([(None,), ("LOW",), ("l",), (" l",), ("25",), ("n",)], "confidence string")
    got = [r[0] for r in features.with_false_alarm_label(df).select(TARGET).collect()]
    assert got == [None, 1, 1, 0, 0, 0]


def test_hour_rounds_down(spark):
    df = spark.createDataFrame([(0,), (59,), (100,), (2359,), (-1,), (None,)], "acq_time bigint")
    assert [r.hour for r in features.with_hour(df).collect()] == [0, 0, 1, 23, -1, None]


def test_bad_times_become_null(spark):
    df = spark.createDataFrame([("0130",), ("abc",), (None,), ("7",)], "acq_time string")
    assert [r.acq_time for r in features.normalise_types(df).collect()] == [130, None, None, 7]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2026-02-28",), ("2026-02-30",), ("x",), (None,)], "acq_date string")
    got = [r.acq_date for r in features.parse_date(df).collect()]
    assert got == [date(2026, 2, 28), None, None, None]
    assert [r.month for r in features.with_month(df).collect()] == [2, None, None, None]


def test_cells_round_half_away_and_join_zeros(spark):
    df = spark.createDataFrame(
        [(0.5, 2.5), (-0.5, -0.3), (0.3, -2.5)], "latitude double, longitude double"
    )
    got = [(r.lat_bin, r.lon_bin) for r in features.with_grid_cell(df).collect()]
    assert got == [(1.0, 3.0), (-1.0, 0.0), (0.0, -3.0)]
    assert all(math.copysign(1, x) == 1 for pair in got for x in pair if x == 0)


@pytest.mark.parametrize("missing", ["brightness", "acq_date", "acq_time"])
def test_missing_inputs_leave_columns_out(spark, missing):
    df = spark.createDataFrame(
        [(300.0, 280.0, date(2026, 1, 1), 130, "kept")],
        "brightness double, bright_t31 double, acq_date date, acq_time bigint, more string",
    ).drop(missing)
    out = set(features.feature_pass(df).columns)
    gone = {"brightness": "delta_t", "acq_date": "month", "acq_time": "hour"}[missing]
    assert out == set(df.columns) | ({"delta_t", "month", "hour"} - {gone})


def test_model_columns_never_hold_the_answer(spark):
    assert "confidence" not in MODEL_COLUMNS
    assert len(PREDICTORS) == 11 and TARGET not in PREDICTORS
    df = spark.createDataFrame([], MODEL_TABLE)
    assert features.numeric_predictors(df) == list(PREDICTORS)
    assert features.numeric_predictors(df, exclude=["scan"]) == [c for c in PREDICTORS if c != "scan"]


def test_class_text(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], f"{TARGET} int")
    got = [r[0] for r in df.select(features.class_label_text()).collect()]
    assert got == ["0 = valid (nominal/high)", "1 = probable false alarm (low)", "7", None]


def test_float32_halves_only_the_named_columns(spark):
    df = spark.createDataFrame([(0.1, 0.1)], "a double, b double")
    assert dict(features.to_float32(df, ["a"]).dtypes) == {"a": "float", "b": "double"}


def test_devices(spark):
    df = spark.createDataFrame([("GPU (x)",), ("gpu",), ("torch/cuda",), ("cuML",), (None,), ("CPU",)], "backend string")
    assert [r.device for r in runs.with_device(df).collect()] == ["GPU", "CPU", "GPU", "GPU", "CPU", "CPU"]


def test_throughput_of_an_instant_run_is_zero(spark):
    df = spark.createDataFrame(
        [(100, 2.0, 10.0, 0.5), (100, 0.0, 10.0, 1.0)], "rows bigint, time_s double, file_mb double, frac double"
    )
    got = [(r.throughput_rows_s, r.throughput_mb_s) for r in runs.with_throughput(df).collect()]
    assert got == [(50.0, 2.5), (0.0, 0.0)]


def test_model_name_suffix(spark):
    df = spark.createDataFrame([("Net  (por epoca)",), ("Net (otra)",)], "model string")
    assert [r.model for r in runs.clean_model_name(df).collect()] == ["Net", "Net (otra)"]


def test_config_text(spark):
    df = spark.createDataFrame([("{'max_depth': 4, 'eta': 0.3}",), ("{'lr': 0.001}",), ("junk",)], "config string")
    got = runs.with_config_values(df, ("max_depth", "eta", "lr")).collect()
    assert [(r.max_depth, r.eta, r.lr) for r in got] == [(4.0, 0.3, None), (None, None, 0.001), (None, None, None)]


def test_hash_depends_on_values_only(spark):
    df = spark.range(1000).withColumn("h", hash32(["id"]))
    again = spark.range(1000).repartition(7).withColumn("h", hash32(["id"]))
    assert df.exceptAll(again).count() == 0
    low, high = df.agg(F.min("h"), F.max("h")).first()
    assert 0 <= low < high < 2**32
    other = spark.range(1000).withColumn("h", hash32(["id"], seed=7))
    assert other.join(df, ["id", "h"]).count() < 5
