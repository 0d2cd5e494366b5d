import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import forest, models


@pytest.fixture(scope="module")
def bent(spark):
    """Rows whose label no single column and no line tells."""
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    y = (x[:, 0] * x[:, 1] + x[:, 2] ** 2 - 1 + 0.2 * r.normal(size=3000) > 0).astype(int)
    return spark.createDataFrame([(k, *map(float, row), int(c)) for k, (row, c) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y int")


def likely(model, rows):
    found = model.transform(models.assemble(rows, list("abcd"))).select("id", "probability").collect()
    return np.array([r.probability[1] for r in sorted(found, key=lambda r: r.id)])


def fitted(rows, trees=5, depth=9, **settings):
    return forest.fit_forest(rows, list("abcd"), "y", trees, depth, key=F.col("id"), **settings)


def test_a_forest_is_the_same_from_any_partitions_and_with_rows_over_many_tasks(spark, bent, monkeypatch):
    """One task with all rows, and levels over all rows until nodes fit a task, grow the same trees from all rows."""
    whole = fitted(bent.repartition(7), weights=(0.7, 1.9))
    assert (likely(whole, bent) == likely(fitted(bent.coalesce(1), weights=(0.7, 1.9)), bent)).all()
    monkeypatch.setattr(forest, "ALONE", 400)
    monkeypatch.setattr(forest, "DEALT", 6000)
    parted = fitted(bent.repartition(5), weights=(0.7, 1.9))
    assert (likely(whole, bent) == likely(parted, bent)).all()
    assert whole.getOrDefault("sizes") == parted.getOrDefault("sizes") and whole.getNumTrees == 5
    assert len({len(t.feature) for t in whole.grown_trees()}) > 1  # every tree has rows of its own


def test_many_trees_are_few_jobs(spark, bent):
    spark.sparkContext.setJobGroup("forest", "forest")
    fitted(bent, 60, 12)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest")) < 10


def test_a_split_is_the_best_of_all_and_leaves_hold_weighted_shares():
    r = np.random.default_rng(3)
    bins, y, times = r.integers(0, 32, (3, 500)).astype(np.uint8), r.integers(0, 2, 500), r.integers(0, 4, 500)
    y = np.where(bins[1] > 20, 1, y)
    plan = forest.Plan(3, 1, 3, (0.6, 2.5), 1)
    tree = forest.grown(bins, forest.paired(y, times), plan, 0)

    def purity(use):
        a, b = (plan.weights[c] * times[use & (y == c)].sum() for c in (0, 1))
        return (a * a + b * b) / (a + b) if a + b else 0.0

    f, cut = max(((f, c) for f in range(3) for c in range(31)), key=lambda s: purity(bins[s[0]] <= s[1]) + purity(bins[s[0]] > s[1]))
    assert (tree.feature[0], tree.split[0], len(tree.feature)) == (f, cut, 3)
    for node, use in ((1, bins[f] <= cut), (2, bins[f] > cut)):
        a, b = (plan.weights[c] * times[use & (y == c)].sum() for c in (0, 1))
        assert tree.value[node] == pytest.approx(b / (a + b))
    assert (forest.Walk(tree).nodes(bins) == np.where(bins[f] <= cut, 1, 2)).all()


def test_rows_are_drawn_once_on_average_and_nodes_see_some_predictors():
    times = forest.bootstrap(np.arange(200_000), 5)
    assert times.mean() == pytest.approx(1, abs=0.01) and times.var() == pytest.approx(1, abs=0.02)
    assert (times == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    seen = forest.Plan(11, 16, 4, (1.0, 1.0), 1).features(0, np.arange(1, 5000))
    assert all(len(set(s)) == 4 for s in seen.tolist()) and np.bincount(seen.reshape(-1)).min() > 1500


def test_a_pure_part_gives_one_leaf_and_an_empty_one_is_an_error(spark, bent):
    assert fitted(bent.where("y = 1"), 2).getOrDefault("sizes") == [1, 1]
    assert (likely(fitted(bent.where("y = 1"), 2), bent) == 1).all()
    with pytest.raises(ValueError):
        fitted(bent.where("id < 0"))
