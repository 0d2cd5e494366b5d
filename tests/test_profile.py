from datetime import date

import numpy as np
import pandas as pd
import pytest

from emberline.operators import profile
from emberline.plans.eda import eda_report
from emberline.registry.views import detections
from emberline.schemas import DETECTIONS

NAN = float("nan")


def test_correlation_deletes_pairs(spark):
    data = [(1.0, 2.0, 5.0), (2.0, NAN, 5.0), (3.0, 5.0, 5.0), (None, 1.0, 5.0), (4.0, 9.5, 5.0), (5.0, 8.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(df).collect()}
    want = pd.DataFrame(data, columns=list("abc")).astype(float).corr()
    assert set(got) == {(x, y) for x in "abc" for y in "abc"}
    assert got["a", "b"] == pytest.approx(want.loc["a", "b"]) == pytest.approx(got["b", "a"])
    assert got["a", "a"] == 1.0
    assert got["c", "c"] is None and got["a", "c"] is None


def test_correlation_keeps_digits_and_does_not_depend_on_tasks(spark):
    """Values far from zero, with gaps, cut into tasks of any size."""
    r = np.random.default_rng(3)
    x = r.normal(size=(2000, 3))
    x[:, 1] = 1e7 + 1e-2 * (x[:, 0] + x[:, 1])
    x[:, 2] -= 0.5 * x[:, 0]
    x[r.random(x.shape) < 0.1] = NAN
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    want = pd.DataFrame(x, columns=list("abc")).corr()
    for parts in (1, 7):
        got = {(p.a, p.b): p.r for p in profile.correlation_matrix(df.repartition(parts)).collect()}
        assert all(got[a, b] == pytest.approx(want.loc[a, b], abs=1e-7) for a in "abc" for b in "abc")


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(None,), (NAN,)], "v double")
    got = profile.histogram(df, "v", bins=5).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 2, 2, 2, 3]
    assert (got[0].bin_low, got[-1].bin_high) == (0.0, 10.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    got = profile.histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [r.n for r in got] == list(np.histogram([3.0] * 4, bins=4)[0])
    assert got[0].bin_low == 2.5 and got[-1].bin_high == 3.5


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(float(x),) for x in range(101)] + [(None,)], "frp double")
    got = sorted((r.frp for r in profile.clip_upper(df).collect() if r.frp is not None))
    assert got[-2:] == [99.0, 99.0] and len(got) == 101


def test_stats_match_numpy_on_ties(spark):
    values = [1.0] * 50 + [2.5] * 3 + [9.0, 1e6]
    df = spark.createDataFrame([(v,) for v in values], "frp double")
    r = profile.frp_stats(df).first()
    assert r.mean == pytest.approx(np.mean(values))
    assert r.std == pytest.approx(np.std(values, ddof=1))
    assert (r.median, r.max) == (1.0, 1e6)
    assert r.p95 == pytest.approx(np.quantile(values, 0.95))
    rough = profile.frp_stats(df, approximate=True).first()
    assert (rough.median, rough.max) == (1.0, 1e6)


def test_shares_sum_to_one_hundred(spark):
    df = spark.createDataFrame([("n",)] * 5 + [("l",)] * 2 + [(None,)], "confidence string")
    got = profile.confidence_distribution(df).collect()
    assert [(r.confidence, r.n) for r in got] == [("n", 5), ("l", 2), (None, 1)]
    assert sum(r.pct for r in got) == pytest.approx(100)


def test_keys_follow_the_columns(spark):
    df = spark.createDataFrame([("N20", date(2026, 1, 5), 1.0), ("N20", date(2026, 2, 5), None)], "satellite string, acq_date date, frp double")
    both = {(r.satellite, r.month): (r.n, r.mean_frp) for r in profile.satellite_month(df).collect()}
    assert both == {("N20", 1): (1, 1.0), ("N20", 2): (1, None)}
    assert profile.satellite_month(df.drop("satellite")).columns == ["month", "n", "mean_frp"]
    assert profile.satellite_month(df.drop("acq_date")).columns == ["satellite", "n", "mean_frp"]


def test_null_profile_orders_by_share(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, `c d` double")
    got = [(r.column, r.type, r.nulls, r.pct_nulls) for r in profile.null_profile(df).collect()]
    assert got == [("c d", "double", 2, 100.0), ("b", "string", 1, 50.0), ("a", "int", 0, 0.0)]


def test_empty_table_gives_a_report(spark):
    empty = spark.createDataFrame([], DETECTIONS)
    report = {name: df.collect() for name, df in eda_report(empty).items()}
    assert report["rows"][0].n == 0
    assert report["frp"][0]["median"] is None and report["frp"][0]["std"] is None
    assert report["peak_days"] == [] and len(report["frp_histogram"]) == 80
    assert all(r.r is None for r in report["correlations"])
    assert profile.null_profile(empty).first().pct_nulls is None


def test_report_parts_agree(spark, small):
    report = eda_report(detections(spark, small))
    total = report["rows"].first().n
    for name in ("daily", "monthly", "hourly", "cells", "satellites", "confidence", "frp_histogram", "frp_histogram_clipped", "contrast"):
        assert sum(r.n for r in report[name].collect()) == total, name
    days = report["daily"].collect()
    assert [r.n for r in report["peak_days"].collect()] == sorted((r.n for r in days), reverse=True)[:3]


def test_layout_does_not_change_results(spark, small):
    df = detections(spark, small)
    mixed = df.repartition(13)
    for work in (profile.frp_stats, profile.top_cells, lambda d: profile.histogram(d, "frp").orderBy("bin")):
        a, b = work(df).collect(), work(mixed).collect()
        for x, y in zip(a, b):
            assert list(x) == pytest.approx(list(y))
