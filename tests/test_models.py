import json
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.functions.hashing import below, hash32
from emberline.operators import boosting, evaluation, models, network
from emberline.operators.blocks import Block, store_blocks, uniform
from emberline.operators.evaluation import classification_metrics, roc_auc
from emberline.plans import modelling
from emberline.registry import model_queries, views
from emberline.schemas import MODEL_METRICS, PREDICTORS, SEARCH_RUNS, TARGET
from emberline.sources.tables import read_split, split_rates


@pytest.fixture(scope="module")
def splits(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("split") / "parts")
    return modelling.store_splits(spark, views.labelled(spark, "/root/testdata/sf0.001"), views.ROW_KEY, path)


def part(spark, splits, name):
    return read_split(spark, splits, name)


def test_stored_parts(spark, splits, small):
    rates = {r.split: r for r in split_rates(spark.read.parquet(splits)).collect()}
    assert sum(r.n for r in rates.values()) == views.labelled(spark, small).count()
    assert max(r.pct_positive for r in rates.values()) - min(r.pct_positive for r in rates.values()) < 0.2
    one = part(spark, splits, "train")
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()


def test_scaling_is_fitted_on_train(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 6.0)], "a double, b double")
    assert tuple(models.standardise(test, train, ["a", "b"]).first()) == (3.0, 1.0)
    assert [tuple(r) for r in models.standardise(train, train, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], f"{TARGET} int")
    got = {r[TARGET]: r.weight for r in models.class_weights(df).collect()}
    assert got == {0: pytest.approx(4 / 6), 1: 2.0}
    assert {r[TARGET]: r.weight for r in models.with_class_weight(df, mode="positive").collect()} == {0: 1.0, 1: 3.0}
    other = spark.createDataFrame([(1,)], f"{TARGET} int")
    assert models.with_class_weight(other, fitted_on=df).first().weight == 2.0


def test_missing_values_are_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        models.assemble(df, ["a", "b"]).collect()


def test_a_bounded_part_is_read_once(spark, tmp_path):
    path = str(tmp_path / "part")
    spark.range(2000).selectExpr("hash(id) AS row", "id", "1 AS a").write.parquet(path)
    part = spark.read.parquet(path)
    some = modelling.bounded(part, 300)
    want = part.where(below(hash32([modelling.ROW]), 0.15))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want.collect())) and 200 < some.count() < 400
    assert some.columns == part.columns and not any(f.startswith(f"file://{path}") for f in some.inputFiles())
    assert modelling.bounded(part, 2000) is part


def test_forest_beats_the_best_single_column_and_repeats(spark, splits, tmp_path):
    train, test = part(spark, splits, "train"), part(spark, splits, "test")
    model = models.train_forest(train, n_estimators=20, max_depth=6)
    scored = models.score(model, test)
    auc = roc_auc(scored, TARGET).first().roc_auc
    rule = max(roc_auc(test.withColumn("s", -F.col(c)), TARGET, "s").first().roc_auc for c in ("delta_t", "frp"))
    assert rule < auc < 0.99
    again = models.score(models.train_forest(train, n_estimators=20, max_depth=6), test)
    assert roc_auc(again, TARGET).first().roc_auc == pytest.approx(auc)
    where = str(tmp_path / "model")
    models.save_model(model, where)
    loaded = models.score(models.load_model(where), test)
    assert loaded.select("score").exceptAll(scored.select("score")).count() == 0
    assert scored.where("(score >= 0.5) <> (pred = 1)").count() == 0


def test_boosting_keeps_the_rounds_up_to_the_lowest_loss(spark, splits):
    train, val = part(spark, splits, "train"), part(spark, splits, "val")
    model = models.train_boosted(train, val, max_depth=6, eta=0.5, rounds=80, patience=4)
    assert 1 <= model.getNumTrees < 80


@pytest.mark.parametrize(
    ("losses", "want"),
    [([3, 2, 1], (3, False)), ([3, 1, 2, 2], (2, True)), ([1, 1, 1], (1, True)), ([2, 3, 1, 3, 3], (3, True)), ([5], (1, False))],
)
def test_patience(losses, want):
    assert boosting.kept_rounds(losses, 2) == want


def test_learning_rates_give_different_networks(spark, splits):
    train = part(spark, splits, "train")
    nets = [models.train_mlp(train, hidden=(8,), epochs=2, batch_size=256, lr=r) for r in (1e-4, 1e-2)]
    scores = [[r.score for r in models.score(n, train, threshold=None).select("score").limit(50).collect()] for n in nets]
    assert scores[0] != scores[1]
    loss = [models.history_frame(spark, n).orderBy(F.desc("epoch")).first().train_loss for n in nets]
    assert loss[1] < loss[0]


def test_layout_follows_content_only(spark):
    df = spark.range(500).selectExpr("id % 37 AS a", "id AS b")
    one, two = (models.laid_out(d, ["a", "b"], 4).rdd.glom().collect() for d in (df.repartition(3), df.coalesce(1)))
    assert one == two and len(one) == 4


def test_comparison_table(spark, splits):
    table = modelling.train_and_compare(
        spark,
        splits,
        forest={"n_estimators": 5, "max_depth": 4},
        boosted={"max_depth": 2, "rounds": 5},
        mlp={"hidden": (16,), "epochs": 10, "batch_size": 256, "lr": 1e-2},
    )
    assert table.schema == MODEL_METRICS
    got = table.collect()
    assert [r.model for r in got] == ["Random Forest", "Boosted Trees", "Neural Network"]
    assert all(0.5 < r.roc_auc < 1 and r.train_time_s > 0 for r in got)


GRID = {
    "forest": ({"n_estimators": 3, "max_depth": 2}, {"n_estimators": 3, "max_depth": 5}, {"n_estimators": 7, "max_depth": 5}),
    "boosted": ({"max_depth": 2, "eta": 0.3}, {"max_depth": 3, "eta": 0.1}),
    "mlp": ({"batch_size": 256, "lr": 1e-3}, {"batch_size": 512, "lr": 1e-2}),
}


def test_search_rows_and_stored_picks(spark, splits, tmp_path, monkeypatch):
    fitted = []
    real = models.train_forest
    monkeypatch.setattr(models, "train_forest", lambda *a, **k: (fitted.append((k["n_estimators"], k["max_depth"])), real(*a, **k))[1])
    table = modelling.search_configs(spark, splits, GRID, boosted={"rounds": 3}, mlp={"hidden": (8,)})
    assert table.schema == SEARCH_RUNS
    got = {r.config: r for r in table.collect()}
    assert set(got) == {str(c) for some in GRID.values() for c in some}
    assert sorted(fitted) == [(3, 2), (3, 5), (4, 5)]  # the forest of seven grows from the one of three
    assert all(0 <= r.f1 <= 1 and r.time_s > 0 for r in got.values())
    assert got[str(GRID["forest"][2])].time_s > got[str(GRID["forest"][1])].time_s and got[str(GRID["forest"][0])].eta is None
    where = str(tmp_path / "best")
    modelling.store_best_configs(table, where)
    picks = {r.model: r.config for r in modelling.best_configs(table).collect()}
    settings = modelling.trained_settings(spark, where)
    assert str(settings["boosted"]) == picks["Boosted Trees"] and str(settings["forest"]) == picks["Random Forest"]
    assert settings["mlp"]["batch_size"] == 32768  # both are too small for a whole training part
    assert modelling.trained_settings(spark, str(tmp_path / "none")) == {}
    seen = {}
    monkeypatch.setattr(modelling, "train_boosted", lambda t, v, **k: (seen.update(k), models.train_boosted(t, v, **k))[1])
    modelling.train_and_compare(spark, splits, boosted={"rounds": 2}, mlp={"hidden": (8,), "epochs": 1}, best=where)
    assert seen["max_depth"] == settings["boosted"]["max_depth"] and seen["rounds"] == 2


def test_a_staged_forest_is_the_mean_of_its_stages(spark, splits):
    train, val = part(spark, splits, "train"), part(spark, splits, "val")
    grid = [{"n_estimators": 2, "max_depth": 3}, {"n_estimators": 5, "max_depth": 3}]
    rows = {r[1]: r[2] for r in models.search_forest(grid, train, val)}
    first = models.train_forest(train, n_estimators=2, max_depth=3, seed=42)
    more = models.train_forest(train, n_estimators=3, max_depth=3, seed=43)
    one = models.score(first, val).withColumnRenamed("score", "s1").drop("pred")
    both = models.score(more, one).withColumn("pred", ((2 * F.col("s1") + 3 * F.col("score")) / 5 >= 0.5).cast("int"))
    assert rows[str(grid[0])] == pytest.approx(classification_metrics(models.score(first, val), TARGET).first()["f1"])
    assert rows[str(grid[1])] == pytest.approx(classification_metrics(both, TARGET).first()["f1"])


def test_default_settings():
    assert models.forest().getNumTrees() == 300 and models.forest().getMaxDepth() == 16
    shape = network.Shape((len(PREDICTORS), *network.HIDDEN, 2), (True, True, False), (0.3, 0.2, 0.0))
    sizes = dict(shape.pieces())
    assert [sizes[f"w{k}"] for k in range(4)] == [(11, 128), (128, 64), (64, 32), (32, 2)]
    assert {"scale0", "scale1"} <= set(sizes) and "scale2" not in sizes
    assert [len(g) for g in models.GRID.values()] == [4, 4, 4]
    deep = max(c["max_depth"] for c in models.GRID["forest"])
    assert deep <= 30


# ---- network ----------------------------------------------------------------------------------------


def some_block(n=40, width=3, number=0):
    r = np.random.default_rng(5 + number)
    x = r.normal(size=(n, width))
    return Block(number, r.integers(-(2**62), 2**62, n), x, (x[:, 0] * x[:, 1] > 0).astype(float))


def test_gradient_equals_finite_differences():
    shape = network.Shape((3, 6, 5, 4, 2), (True, True, False), (0.3, 0.2, 0.0))
    weights, _ = network.initial(shape, 1)
    weights = weights + np.random.default_rng(2).normal(0, 0.05, len(weights))
    block, h = some_block(), 1e-6
    gradient = network.block_sums(shape, weights, block, 11).gradient
    for k in np.random.default_rng(3).choice(len(weights), 60, replace=False):
        step = np.zeros_like(weights)
        step[k] = h
        up, down = (network.block_sums(shape, weights + s, block, 11).loss for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_dropout_follows_rows_epochs_and_units():
    keys = np.arange(20_000, dtype=np.int64) - 9_000
    u = uniform(keys, 7, 5)
    assert u.shape == (20_000, 5) and abs((u < 0.3).mean() - 0.3) < 0.01
    assert (uniform(keys[5:9], 7, 5) == u[5:9]).all() and (uniform(keys, 8, 5) != u).mean() > 0.99
    assert abs(np.corrcoef(u[:, 0], u[:, 1])[0, 1]) < 0.03


def test_a_step_works_in_place_and_leaves_its_rows_alone():
    """Dropout is decided on whole numbers, as on their shares of one; a block's rows stay as they are."""
    keys = np.arange(-500, 500)
    for share in (0.0, 0.1, 0.2, 0.3, 1 / 3, 1.0):
        assert ((network.drawn(keys, 5, 7) >= network.limit(share)) == (uniform(keys, 5, 7) >= share)).all()
    shape = network.Shape((3, 128, 64, 2), (True, True), (0.3, 0.2))
    r = np.random.default_rng(2)
    weights, _ = network.initial(shape, 1)
    block = Block(0, np.arange(256), r.normal(size=(256, 3)), r.integers(0, 2, 256).astype(float))
    before = block.x.copy()
    network.block_sums(shape, weights, block, 1)
    tracemalloc.start()
    network.block_sums(shape, weights, block, 1)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (block.x == before).all()
    assert most < 5.2 * 256 * (128 + 64) * 8  # 4.9; with a new matrix for every term it was 5.4


def test_adam_goes_down_a_bowl():
    adam, w = network.Adam(2, 0.1), np.array([3.0, -2.0])
    for _ in range(300):
        w = adam.moved(w, 2 * w)
    assert np.abs(w).max() < 1e-2


@pytest.fixture(scope="module")
def bent(spark):
    """Rows whose label no single column and no line tells."""
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    y = (x[:, 0] * x[:, 1] + x[:, 2] ** 2 - 1 + 0.2 * r.normal(size=3000) > 0).astype(int)
    df = spark.createDataFrame([(k, *map(float, row), int(c)) for k, (row, c) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y int")
    return df.where("id % 4 > 0"), df.where("id % 4 = 0")


def test_network_learns_and_does_not_depend_on_partitions(spark, bent):
    train, val = bent
    fits = [
        network.fit_network(d, val, list("abcd"), "y", epochs=5, batch_size=256, lr=5e-3, key=F.col("id"), parts=p)
        for d, p in ((train.repartition(5), 2), (train.coalesce(1), 8))
    ]
    one, two = ([(e.train_loss, e.val_loss) for e in m.history] for m in fits)
    assert np.allclose(one, two, atol=1e-6)
    losses = [e.train_loss for e in fits[0].history]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.7 * losses[0]
    best = min(fits[0].history, key=lambda e: e.val_loss)
    assert fits[0].getOrDefault("weights") == best.weights.tolist() and best.val_acc > 0.8


def test_an_epoch_is_one_job_with_the_steps_in_it(spark, bent):
    train, val = bent
    sc = spark.sparkContext
    fits = {}
    for name, parts in (("lanes", None), ("steps", 1)):
        sc.setJobGroup(name, name)
        fits[name] = network.fit_network(train, val, list("abcd"), "y", epochs=3, batch_size=32, key=F.col("id"), parts=parts)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert network.history_rows(fits["lanes"]) == network.history_rows(fits["steps"])
    assert fits["lanes"].getOrDefault("weights") == fits["steps"].getOrDefault("weights")
    jobs = {name: len(sc.statusTracker().getJobIdsForGroup(name)) for name in fits}
    assert jobs["lanes"] < 25 < jobs["steps"]


def test_several_lanes_learn_and_do_not_depend_on_files(spark, bent):
    shape = network.Shape((4, 16, 2), (True,), (0.0,))
    runs = []
    for d in (bent[0], bent[0].repartition(5)):
        stored = store_blocks(d, list("abcd"), "y", 32, F.col("id"), part_rows=400)
        assert stored.parts > 2
        lanes = stored.lanes(spark)
        owners = lanes.mapPartitionsWithIndex(lambda k, some: [(b.number, k) for b in some]).collect()
        assert len({n for n, _ in owners}) == len(set(owners)) > 20
        runs.append(network.run_epochs(lanes, None, stored.rows, shape, 6, 64, 1e-2, 42, lanes=True))
        lanes.unpersist()
    assert runs[0][-1].train_loss < 0.7 * runs[0][0].train_loss
    for a, b in zip(*runs, strict=True):
        assert np.allclose(a.weights, b.weights) and a.train_loss == pytest.approx(b.train_loss)


def test_a_network_is_saved_with_its_scaler(spark, splits, tmp_path):
    train, val, test = (part(spark, splits, s) for s in ("train", "val", "test"))
    model = models.train_mlp(train, val, hidden=(8, 4), epochs=2, batch_size=512)
    where = str(tmp_path / "net")
    models.save_model(model, where)
    before = models.score(model, test, threshold=None).withColumnRenamed("score", "before").drop("pred")
    after = models.score(models.load_model(where), before, threshold=None)
    assert after.count() == test.count() and after.where("score <> before").count() == 0
    assert after.where("(score > 0.5) <> (pred = 1)").count() == 0
    moments = train.agg(F.avg("frp"), F.stddev_pop("frp")).first()
    scaler = models.load_model(where).stages[0]
    at = scaler.getOrDefault("names").index("frp")
    assert (scaler.getOrDefault("means")[at], scaler.getOrDefault("spreads")[at]) == pytest.approx(tuple(moments))


def test_blocks_follow_keys_only_and_hold_every_row(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as double) AS a", "cast(id % 2 as int) AS y")
    read = lambda d: sorted(
        (b.number, k, x[0], y) for b in store_blocks(d, ["a"], "y", 50, F.col("id"), part_rows=300).read(spark).collect() for k, x, y in zip(b.key, b.x, b.y)
    )
    one = read(df.repartition(7))
    assert one == read(df.coalesce(1)) and sorted(k for _, k, _, _ in one) == list(range(1000))
    hot = spark.range(2000).selectExpr("1.0D AS a", "1 AS y")
    sizes = [len(b.y) for b in store_blocks(hot, ["a"], "y", 50).read(spark).collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 100  # a block has twice its rows at most
    with pytest.raises(Exception, match="null or NaN"):
        store_blocks(df.withColumn("a", F.when(F.col("id") != 3, F.col("a"))), ["a"], "y", 50)


# ---- boosting ---------------------------------------------------------------------------------------


def test_boosting_does_not_depend_on_partitions(spark, bent):
    train, val = bent
    fits = [
        boosting.fit_boosted(d, val, list("abcd"), "y", max_depth=4, eta=0.3, rounds=6, key=F.col("id"), parts=p)
        for d, p in ((train.repartition(5), 2), (train.coalesce(1), 8))
    ]
    assert fits[0].losses == fits[1].losses and fits[0].getOrDefault("trees") == fits[1].getOrDefault("trees")
    assert fits[0].losses == sorted(fits[0].losses, reverse=True) and fits[0].losses[-1] < 0.45


def test_every_round_is_made_once_and_patience_stops_a_running_fit(spark, bent, monkeypatch):
    train, val = bent
    made = []
    real = boosting.grown
    monkeypatch.setattr(boosting, "KEEP", 3)
    monkeypatch.setattr(boosting, "grown", lambda *a: (made.append(1), real(*a))[1])
    noise = val.withColumn("y", (F.hash("id") % 2 == 0).cast("int"))  # nothing to learn: the loss soon rises
    model = boosting.fit_boosted(train, noise, list("abcd"), "y", max_depth=3, eta=0.5, rounds=60, patience=4, key=F.col("id"))
    assert len(made) == len(model.losses) < 60
    assert model.getNumTrees == int(np.argmin(model.losses)) + 1 == len(model.losses) - 4


def test_the_first_split_is_the_best_of_all(spark):
    """One level, no sampling: the split of a plain search over all limits."""
    r = np.random.default_rng(7)
    x = r.integers(0, 30, (400, 2)).astype(float)
    y = ((x[:, 1] > 17) ^ (r.random(400) < 0.1)).astype(int)
    df = spark.createDataFrame([(*map(float, row), int(c)) for row, c in zip(x, y)], "a double, b double, y int")
    model = boosting.fit_boosted(df, None, ["a", "b"], "y", 1, 1.0, 1, 1.0, 1.0, positive_weight=1.0)
    g, h = 0.5 - y, np.full(400, 0.25)
    gain = lambda m: sum(g[k].sum() ** 2 / (h[k].sum() + 1) for k in (m, ~m) if k.any())
    f, limit = max(((f, t) for f in (0, 1) for t in range(1, 30)), key=lambda c: gain(x[:, c[0]] < c[1]))
    tree, cuts = model.grown_trees()[0], json.loads(model.getOrDefault("cuts"))
    assert tree.feature[0] == f and cuts[f][tree.split[0]] == limit
    low = x[:, f] < limit
    assert tree.value[1:] == pytest.approx([-g[m].sum() / (h[m].sum() + 1) for m in (low, ~low)], abs=1e-5)


def test_boosted_model_is_saved_and_loaded(spark, bent, tmp_path):
    train, val = bent
    model = boosting.fit_boosted(train, None, list("abcd"), "y", max_depth=3, eta=0.3, rounds=4)
    rows = models.assemble(val, list("abcd"))
    models.save_model(model, str(tmp_path / "trees"))
    again = models.load_model(str(tmp_path / "trees"))
    assert again.transform(rows).select("id", "prediction").exceptAll(model.transform(rows).select("id", "prediction")).count() == 0
    same = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "a double, y int")
    flat = boosting.fit_boosted(same, None, ["a"], "y", rounds=2)
    assert flat.transform(models.assemble(same, ["a"])).select("prediction").distinct().count() == 1


# ---- rule against classifier ----------------------------------------------------------------------------


def test_rule_and_model_at_equal_recall(spark):
    rows = [(1, 1.0, 0.9), (1, 2.0, 0.8), (1, 9.0, 0.7), (0, 3.0, 0.75), (0, 8.0, 0.1), (0, 1.5, 0.2), (0, float("nan"), 0.95)]
    df = spark.createDataFrame(rows, "y int, delta double, score double")
    both = evaluation.rule_and_model(df, "delta", 4.0)
    assert sorted((r.delta, r.rule, r.model) for r in both.collect() if r.y) == [(1.0, 1, 1), (2.0, 1, 1), (9.0, 0, 0)]
    table = {r.y: tuple(r)[1:] for r in evaluation.paired_table(both).collect()}
    assert table == {0: (4, 1, 1, 2, 0), 1: (3, 2, 0, 0, 1)}
    none = evaluation.rule_and_model(df.where("y = 0"), "delta", 4.0)
    assert none.agg(F.sum("model")).first()[0] == 0
    swept = spark.createDataFrame([(1.0, 0.5), (2.0, 0.7), (3.0, 0.7)], "threshold double, f1 double")
    assert evaluation.best_threshold(swept) == 2.0


def test_validation_losses_are_read_no_sooner_than_the_fit_can_end(spark, bent):
    assert boosting.next_look([], 25) == 26 and boosting.next_look([3.0, 2.0, 1.0], 2) == 5 and boosting.next_look([1.0, 2.0], 3) == 4
    train, val = bent
    sc = spark.sparkContext
    sc.setJobGroup("boosted", "boosted")
    model = boosting.fit_boosted(train, val, list("abcd"), "y", max_depth=1, eta=0.3, rounds=20, patience=5)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.losses) == 20
    assert len(sc.statusTracker().getJobIdsForGroup("boosted")) < 45  # with four looks; a look a round is 16 jobs more than that
    rows = model.transform(models.assemble(val, list("abcd"))).withColumn("y", F.col("y").cast("double"))
    assert models.loss_and_accuracy(model, rows.select("features", "y"), "y")[0] == pytest.approx(min(model.losses))


# ---- heads ----------------------------------------------------------------------------------------------


def test_head_and_history_on_stored_vectors(spark, small):
    rows = views.table(spark, small, "embeddings")
    train, test = rows.where(below(hash32(["vec_id"]), 0.8)), rows.where(~below(hash32(["vec_id"]), 0.8))
    model = models.train_head(train, "embedding", "label", 64, 10, test, epochs=4, lr=1e-2)
    val = models.vector_features(test, "embedding", "label")
    assert model.transform(val).count() == test.count()
    history = models.history_frame(spark, model)
    got = history.collect()
    assert [r.epoch for r in got] == [1, 2, 3, 4] and got[3].train_loss < got[0].train_loss
    best = models.pick_best_epoch(history).first()
    assert best.val_loss == min(r.val_loss for r in got)
    assert models.loss_and_accuracy(model, val, "label")[0] == pytest.approx(best.val_loss)
    linear = models.train_head(train, "embedding", "label", 64, 10, hidden=(), epochs=1)
    assert linear.transform(val).count() == test.count()


# ---- levels of a boosted tree -----------------------------------------------------------------------------


def test_blocks_are_dealt_evenly(spark):
    df = spark.range(4000).selectExpr("id", "cast(id as double) AS a", "cast(id % 2 as int) AS y")
    blocks = store_blocks(df, ["a"], "y", 100, F.col("id"))
    sizes = [len({b.number for b in some}) for some in blocks.dealt(spark, 5).glom().collect()]
    assert sizes == [8] * 5


def test_few_rows_get_few_partitions_and_none_gets_too_many():
    sized = lambda n: boosting.Blocks("", n, -(-n // boosting.BLOCK_ROWS), 1, 1)
    assert [boosting.part_count(sized(n), 12) for n in (0, 1000, 600_000, 24_000_000, 26_000_000)] == [1, 1, 3, 12, 24]


def test_a_level_with_few_histograms_has_one_stage_and_the_same_trees(spark, bent, monkeypatch):
    train, _ = bent

    def fitted(name):
        spark.sparkContext.setJobGroup(name, name)
        found = boosting.fit_boosted(train, None, list("abcd"), "y", max_depth=4, eta=0.3, rounds=2, key=F.col("id"), parts=3)
        spark.sparkContext.setJobGroup("", "")
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(name)]
        return found.getOrDefault("trees"), sum(len(j.stageIds) for j in jobs if j)

    few, stages = fitted("few")
    monkeypatch.setattr(boosting, "FEW", 1)
    many, more = fitted("many")
    assert few == many and more == stages + 8


def test_histograms_are_the_sums_of_the_sampled_rows():
    r = np.random.default_rng(3)
    rows = boosting.Rows(r.integers(0, 9999, 500), r.integers(0, 256, (3, 500)).astype(np.uint8), r.integers(0, 2, 500), r.normal(size=500))
    seen = boosting.sampled(rows, np.array([0, 2]), 0.5, 11, 2.0)
    use = uniform(rows.key, 11) < 0.5
    assert (seen.bins == rows.bins[[0, 2]][:, use]).all() and 200 < use.sum() < 300
    tree = boosting.Tree()
    tree.grow(0, 1, 100, (0.0, 0.0))  # by the second of the tree's predictors
    found = dict(boosting.histograms([seen, seen], boosting.Walk(tree), [2]))
    right = seen.bins[1] > 100
    assert list(found) == [2] and found[2].shape == (2, 2, 256)
    for which in (0, 1):
        for k in (0, 1):
            want = np.zeros(256)
            np.add.at(want, seen.bins[k, right], seen.both[which, right])
            assert (found[2][which, k] == 2 * want).all()
    p = 1 / (1 + np.exp(-rows.margin[use]))
    assert np.allclose(seen.both[0] / boosting.UNIT, (p - rows.y[use]) * np.where(rows.y[use] > 0, 2.0, 1.0), atol=1e-6)


# ---- whole parts in the registered queries ------------------------------------------------------------------


def forest_row_counts(spark, monkeypatch, run) -> set[int]:
    """Rows that forests are fitted on while something runs; the other learners and all scores are left out."""
    class Seen(Exception):
        pass

    counts = set()

    def seen(train, *a, **k):
        counts.add(train.count())
        raise Seen

    monkeypatch.setattr(models, "train_forest", seen)
    monkeypatch.setattr(modelling, "train_forest", seen)
    for name in ("train_boosted", "train_mlp"):
        monkeypatch.setattr(modelling, name, lambda *a, **k: (_ for _ in ()).throw(Seen))
    with pytest.raises(Seen):
        run()
    return counts


@pytest.fixture
def many_rows(spark, splits, monkeypatch):
    """More training rows than any bound there was."""
    train = part(spark, splits, "train")
    monkeypatch.setattr(model_queries, "stored", lambda *a: splits)
    monkeypatch.setattr(model_queries, "FIT_ROWS", train.count() // 4)
    return train.count()


def test_search_fits_forests_on_all_training_rows(spark, small, many_rows, monkeypatch):
    assert forest_row_counts(spark, monkeypatch, lambda: model_queries.search_query(spark, small)) == {many_rows}


def test_best_configs_fits_forests_on_all_training_rows(spark, small, many_rows, monkeypatch):
    """Both by its search and by its training with the stored picks."""
    assert forest_row_counts(spark, monkeypatch, lambda: model_queries.best_configs_query(spark, small)) == {many_rows}
    table = spark.createDataFrame([("Random Forest", "{'n_estimators': 20}")], "model string, config string")
    monkeypatch.setattr(modelling, "search_configs", lambda *a, **k: table)
    monkeypatch.setattr(modelling, "best_configs", lambda t, tolerance=0.01: t)
    assert forest_row_counts(spark, monkeypatch, lambda: model_queries.best_configs_query(spark, small)) == {many_rows}


def test_compare_models_fits_its_forest_on_all_training_rows(spark, small, many_rows, monkeypatch):
    assert forest_row_counts(spark, monkeypatch, lambda: model_queries.comparison_query(spark, small)) == {many_rows}


def test_rule_against_model_pairs_fits_its_forest_on_all_training_rows(spark, small, many_rows, monkeypatch):
    assert forest_row_counts(spark, monkeypatch, lambda: model_queries.rule_pairs_query(spark, small)) == {many_rows}


# ---- trees grown within a task ------------------------------------------------------------------------------


def test_a_task_grows_the_same_trees_as_jobs_by_level(spark, bent, monkeypatch):
    """Rows that fit one task: the same trees and losses, a job or two for every look at the losses."""
    train, val = bent

    def fitted(name, **settings):
        spark.sparkContext.setJobGroup(name, name)
        found = boosting.fit_boosted(train, val, list("abcd"), "y", max_depth=5, eta=0.3, rounds=40, patience=6, key=F.col("id"), **settings)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found.getOrDefault("trees"), found.losses, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    alone, losses, jobs = fitted("alone")
    monkeypatch.setattr(boosting, "ALONE", 0)
    levels, more_losses, more_jobs = fitted("levels")
    assert alone == levels and losses == more_losses
    assert jobs < 40 < 150 < more_jobs
    three, three_losses, _ = fitted("three", parts=3)
    assert three == alone and three_losses == losses


def test_best_splits_of_several_nodes_are_those_of_each():
    r = np.random.default_rng(4)
    sums = np.stack([r.integers(-(2**22), 2**22, (6, 3, 256)), r.integers(0, 2**18, (6, 3, 256))], 1)
    sums[4] = 0
    features = np.array([1, 4, 6])
    assert boosting.best_of(sums, features) == [boosting.best_split(s, features) for s in sums]


# ---- disk of fits ---------------------------------------------------------------------------------------------


def test_a_network_leaves_no_stored_blocks(spark, bent):
    from pathlib import Path

    from emberline.session import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file://"), "emberline")
    before = set(folder.glob("blocks-*"))
    network.fit_network(*bent, list("abcd"), "y", epochs=1, batch_size=256, key=F.col("id"))
    assert set(folder.glob("blocks-*")) <= before


def test_fits_of_many_rows_run_one_at_a_time(spark, monkeypatch):
    rows = spark.range(50)
    assert modelling.at_once(rows, 4) == 4
    monkeypatch.setattr(modelling, "ALONE", 40)
    assert modelling.at_once(rows, 4) == 1
