import math

import pytest
from pyspark.sql import functions as F

from emberline.operators import sampling
from emberline.operators.ranking import with_rank
from emberline.registry.views import ROW_KEY, labelled
from emberline.sources.tables import with_file_position
from emberline.schemas import TARGET


def test_steps():
    assert sampling.step_for(52_508_479, 1_591_167) == 32
    assert sampling.step_for(10, 100) == 1
    assert sampling.step_of_fraction(0.03) == 33 and sampling.step_of_fraction(0.3) == 3


@pytest.mark.parametrize("n, k", [(100, 7), (99, 33), (1, 5), (10, 1)])
def test_every_kth_size(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "position")
    got = sorted(r.position for r in sampling.every_kth(df, k).collect())
    assert got == list(range(0, n, k)) and len(got) == math.ceil(n / k)


def test_file_position_over_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    got = with_file_position(spark, path).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1000))
    assert [r.id for r in got] == list(range(1000))
    first = sampling.prefix_fraction(with_file_position(spark, path), 0.123)
    assert sorted(r.id for r in first.collect()) == list(range(123))


def test_file_position_of_one_file_needs_no_shuffle(spark, small):
    plan = with_file_position(spark, f"{small}/events.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_prefix_by_key(spark):
    df = with_rank(spark.range(10).select((F.col("id") * 10).alias("k")), "k")
    assert sorted(r.k for r in sampling.prefix_fraction(df, 0.35).collect()) == [0, 10, 20]


@pytest.mark.parametrize("frac, rounding, size", [(0.15, "down", 149), (0.15, "nearest", 150), (0.0, "down", 0), (1.0, "down", 999)])
def test_exact_fraction_size(spark, frac, rounding, size):
    df = spark.range(999)
    got = [r.id for r in sampling.exact_fraction(df, frac, ["id"], rounding=rounding).collect()]
    assert len(got) == len(set(got)) == size
    again = [r.id for r in sampling.exact_fraction(df.repartition(5), frac, ["id"], rounding=rounding).collect()]
    assert sorted(got) == sorted(again)


def test_bernoulli_by_key_is_stable(spark):
    a = {r.id for r in sampling.bernoulli(spark.range(4000), 0.25, keys=["id"]).collect()}
    b = {r.id for r in sampling.bernoulli(spark.range(4000).repartition(9), 0.25, keys=["id"]).collect()}
    assert a == b and 850 < len(a) < 1150
    assert 850 < sampling.bernoulli(spark.range(4000), 0.25).count() < 1150


def test_published_split_sizes(spark):
    counts = spark.createDataFrame([(0, 46_126_325), (1, 6_382_154)], "class int, n bigint")
    got = sampling.split_sizes(counts).collect()
    assert sum(r.n_train for r in got) == 36_755_935
    assert sum(r.n_test for r in got) == 7_876_272
    assert sum(r.n_val for r in got) == 7_876_272
    for r in got:
        assert r.n_train + r.n_val + r.n_test == r.n
        assert abs(r.n_train / r.n - 0.70) < 1e-6


def test_sizes_beyond_64_bit_products(spark):
    counts = spark.createDataFrame([(0, 900_000_000_000), (1, 100_000_000_001)], "class int, n bigint")
    got = sampling.split_sizes(counts).collect()
    assert sum(r.n_test for r in got) == 150_000_000_001
    assert sum(r.n_train for r in got) == 1_000_000_000_001 - 300_000_000_001


def test_exact_split_is_a_partition_with_exact_sizes(spark, small):
    df = labelled(spark, small)
    split = sampling.exact_stratified_split(df, ROW_KEY)
    n = df.count()
    parts = {(r.split, r[TARGET]): r["count"] for r in split.groupBy("split", TARGET).count().collect()}
    assert sum(parts.values()) == n
    held = math.ceil(n * 30 / 100)
    assert parts["test", 0] + parts["test", 1] == math.ceil(held / 2)
    assert parts["train", 0] + parts["train", 1] == n - held
    share = sum(v for (s, c), v in parts.items() if c == 1) / n
    for s in ("train", "val", "test"):
        assert abs(parts[s, 1] / (parts[s, 0] + parts[s, 1]) - share) < 0.001
    assert split.drop("split").exceptAll(df).count() == 0
    again = sampling.exact_stratified_split(df.repartition(11), ROW_KEY)
    assert split.select(*ROW_KEY, "split").exceptAll(again.select(*ROW_KEY, "split")).count() == 0


def test_rows_without_a_listed_class_are_kept(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 < 2, (F.col("id") % 3).cast("int")).alias(TARGET))
    split = sampling.exact_stratified_split(df, ["id"])
    assert split.count() == 300
    assert split.where(f"{TARGET} IS NULL").select("split").distinct().count() == 3
