import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators.ranking import exact_quantiles, null_safe_join, running_totals, value_counts, with_rank, with_value_range


def skewed(spark, n=3000):
    """One value holds a third of the rows, one group holds more than half."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        value = 7.0 if i % 3 == 0 else round(rng.uniform(-50, 50), 2)
        group = "hot" if i % 5 < 3 else rng.choice(["a", "b", None])
        data.append((group, value))
    return data, spark.createDataFrame(data, "g string, v double")


@pytest.mark.parametrize("ranges", [2, 3, 40])
def test_running_totals_equal_a_sorted_walk(spark, ranges):
    data, df = skewed(spark)
    got = running_totals(value_counts(df, "v"), "value", ["n"], ranges=ranges).orderBy("value").collect()
    before = 0
    for r in got:
        assert r.before_n == before
        assert r.total_n == len(data)
        assert r.n == sum(v == r.value for _, v in data)
        before += r.n
    assert before == len(data)


def test_groups_with_a_null_key_are_kept_apart(spark):
    data, df = skewed(spark)
    got = running_totals(value_counts(df, "v", ["g"]), "value", ["n"], ["g"], ranges=5).collect()
    for g in ("hot", "a", "b", None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.value)
        before = 0
        for r in mine:
            assert r.before_n == before
            before += r.n
        assert before == sum(x == g for x, _ in data)
        assert {r.total_n for r in mine} == {before}


def test_quantiles_match_numpy(spark):
    data, df = skewed(spark)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = exact_quantiles(df, "v", probs, by=["g"]).collect()
    for r in got:
        values = [v for g, v in data if g == r.g]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


@pytest.mark.parametrize("method, numpy_method", [("discrete", "inverted_cdf"), ("nearest", None)])
def test_other_quantile_rules(spark, method, numpy_method):
    data, df = skewed(spark, 1001)
    values = sorted(v for _, v in data)
    for p in (0.05, 0.5, 0.95):
        got = exact_quantiles(df, "v", {"q": p}, method=method).first().q
        if numpy_method:
            want = np.quantile(values, p, method=numpy_method)
        else:
            want = values[int((len(values) - 1) * p + 0.5)]
        assert got == want


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(4.0,)], "v double")
    assert exact_quantiles(one, "v", {"q": 0.3}).first().q == 4.0
    none = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(none, "v", {"q": 0.3}).first().q is None


def test_rank_is_position_by_key_whatever_the_layout(spark):
    df = spark.range(0, 5000, 3).select((F.col("id") * 7919 % 100003).alias("k")).repartition(6)
    got = with_rank(df, "k", ranges=9).orderBy("k").collect()
    assert [r.position for r in got] == list(range(len(got)))


def test_null_safe_join_keeps_left_names(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("y", 30)], "k string, w int")
    got = sorted(map(tuple, null_safe_join(a, b, ["k"], "left").collect()), key=lambda r: r[1])
    assert got == [(None, 1, 10), ("x", 2, None)]


@pytest.mark.parametrize("ranges", [2, 5, 16, 100])
def test_ranges_are_in_order_and_even(spark, ranges):
    df = spark.range(4000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    got = with_value_range(df, "v", ["n"], ranges).groupBy("_range").agg(F.min("v"), F.max("v"), F.count("*"))
    rows = sorted(map(tuple, got.collect()))
    assert [r[0] for r in rows] == list(range(ranges))
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:]))
    assert max(r[3] for r in rows) <= 2 * 4000 / ranges
    empty = with_value_range(df.limit(0), "v", ["n"], ranges)
    assert empty.count() == 0
