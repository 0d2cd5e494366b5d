"""Queries that prepare, train and judge classifiers on detections and stored vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions.hashing import below, hash32
from emberline.operators import evaluation, models, network
from emberline.operators.evaluation import roc_auc
from emberline.plans import modelling
from emberline.registry import views
from emberline.registry.book import register
from emberline.registry.detection_queries import SIZES, rounded, typed
from emberline.registry.views import ROW_KEY, hash_sql, sql_with
from emberline.schemas import PREDICTORS, TARGET
from emberline.session import scratch_path
from emberline.sources import run_files
from emberline.sources.tables import read_split

# The forests of ``train_forest`` and ``score`` are fitted on at most about this many labelled rows; all else uses whole parts.
FIT_ROWS = 3_000


def stored(spark: SparkSession, sf_dir: str) -> str:
    return modelling.store_splits(spark, views.labelled(spark, sf_dir), ROW_KEY)


# ---- preparation ----------------------------------------------------------------------------------

TRAIN = f"{hash_sql(*ROW_KEY)} < {int(0.70 * 2**32)}"


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = views.labelled(spark, sf_dir)
    in_train = below(hash32(ROW_KEY), 0.70)
    return rows.where(in_train), rows.where(~in_train)


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = models.assemble(views.labelled(spark, sf_dir))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return vectors.groupBy("satellite").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(total), 6).alias("mean_sum"),
        F.max(F.size(vector_to_array("features"))).alias("width"),
    )


register(
    "assemble",
    "L1",
    assembled,
    sql_with(
        "lab",
        f"SELECT satellite, count(*) AS n, round(avg({' + '.join(PREDICTORS)}), 6) AS mean_sum, {len(PREDICTORS)} AS width "
        "FROM lab GROUP BY satellite",
    ),
)


def standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of the held-out rows on the scale of the training rows."""
    train, rest = parts(spark, sf_dir)
    scaled = models.standardise(rest, train)
    return scaled.agg(
        *[F.round(F.avg(c), 6).alias(f"mean_{c}") for c in PREDICTORS],
        *[F.round(F.stddev_pop(c), 6).alias(f"std_{c}") for c in PREDICTORS],
    )


register(
    "standardise",
    "L2",
    standardised,
    sql_with(
        "lab",
        "SELECT "
        + ", ".join(
            [f"round(avg(({c} - m_{c}) / s_{c}), 6) AS mean_{c}" for c in PREDICTORS]
            + [f"round(stddev_pop(({c} - m_{c}) / s_{c}), 6) AS std_{c}" for c in PREDICTORS]
        )
        + f" FROM lab, fit WHERE NOT ({TRAIN})",
        fit="SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in PREDICTORS)
        + f" FROM lab WHERE {TRAIN}",
    ),
)
register(
    "class_weights",
    "L6",
    lambda spark, sf_dir: rounded(
        typed(models.class_weights(views.labelled(spark, sf_dir)), "int", TARGET), 9, "weight"
    ),
    sql_with(
        "lab",
        "SELECT CAST(is_false_alarm AS INTEGER) AS is_false_alarm, count(*) AS n, "
        "round((SELECT count(*) FROM lab) / ((SELECT count(DISTINCT is_false_alarm) FROM lab) * count(*)), 9) AS weight "
        "FROM lab GROUP BY is_false_alarm",
    ),
)
register(
    "class_weights_positive",
    "L6 A25",
    lambda spark, sf_dir: rounded(
        typed(models.class_weights(views.labelled(spark, sf_dir), mode="positive"), "int", TARGET), 9, "weight"
    ),
    sql_with(
        "lab",
        "SELECT CAST(is_false_alarm AS INTEGER) AS is_false_alarm, count(*) AS n, "
        "CASE is_false_alarm WHEN 1 THEN round((SELECT count(*) FROM lab WHERE is_false_alarm = 0) / count(*), 9) ELSE 1 END "
        "AS weight FROM lab GROUP BY is_false_alarm",
    ),
)

# ---- training ---------------------------------------------------------------------------------------

# What a fitted model must satisfy whatever its numbers: it scores every test row, its decision is its score at
# one half, and it ranks better than the best rule on one column, whose area SQL computes from the same rows.
RULE_COLUMNS = ("delta_t", "brightness", "frp")
NUMBERED = {
    "numbered": f"SELECT *, row_number() OVER (PARTITION BY is_false_alarm ORDER BY {hash_sql(*ROW_KEY)}, {', '.join(ROW_KEY)}) AS r FROM lab",
    "split": "SELECT numbered.*, CASE WHEN r <= n_train THEN 'train' WHEN r <= n - n_test THEN 'val' ELSE 'test' END AS split "
    "FROM numbered JOIN parts ON is_false_alarm = c",
}
RULE_AREA = {
    **SIZES,
    **NUMBERED,
    "ranked": " UNION ALL ".join(
        f"SELECT '{c}' AS name, is_false_alarm AS y, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS place "
        "FROM split WHERE split = 'test'"
        for c in RULE_COLUMNS
    ),
    "area": "SELECT name, (sum(place) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2) "
    "/ (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS a FROM ranked GROUP BY name",
}
RULE_AUC = "(SELECT round(max(greatest(a, 1 - a)), 9) FROM area)"
TEST_ROWS = sql_with(
    "lab",
    f"SELECT CAST(c AS INTEGER) AS is_false_alarm, CAST(n_test AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_other_decision, "
    f"{RULE_AUC} AS rule_auc, true AS beats_rule FROM parts",
    **RULE_AREA,
)


def rule_auc(rows: DataFrame) -> float:
    """Area of the best rule on one column, in the better direction."""
    found = [roc_auc(rows, TARGET, c).first()["roc_auc"] for c in RULE_COLUMNS]
    return round(max(max(a, 1 - a) for a in found), 9)


def stored_scores(spark: SparkSession, model, test: DataFrame, threshold: float | None = 0.5) -> DataFrame:
    where = scratch_path(spark, "judged")
    models.score(model, test, threshold=threshold).write.parquet(where)
    return spark.read.parquet(where)


def judged(spark: SparkSession, scored: DataFrame) -> DataFrame:
    rule, auc = rule_auc(scored), roc_auc(scored, TARGET).first()["roc_auc"]
    return scored.groupBy(F.col(TARGET).cast("int").alias(TARGET)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("score") >= 0.5) != (F.col("pred") == 1)).alias("n_other_decision"),
        F.lit(rule).alias("rule_auc"),
        F.lit(auc > rule).alias("beats_rule"),
    )


def split_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    path = stored(spark, sf_dir)
    return [read_split(spark, path, name) for name in ("train", "val", "test")]


def step_rows(train: DataFrame) -> int:
    """Rows of a network's step: the default is for millions of rows, a smaller part gets some sixteen steps an epoch."""
    return max(network.GHOST, min(network.BATCH, train.count() // 16))


def small_forest_rows(train: DataFrame) -> DataFrame:
    return modelling.bounded(train, FIT_ROWS)


def forest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = split_parts(spark, sf_dir)
    return judged(spark, stored_scores(spark, models.train_forest(small_forest_rows(train)), test))


def boosted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val, test = split_parts(spark, sf_dir)
    return judged(spark, stored_scores(spark, models.train_boosted(train, val, key=F.col(modelling.ROW)), test))


def mlp_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val, test = split_parts(spark, sf_dir)
    model = models.train_mlp(train, val, key=F.col(modelling.ROW), batch_size=step_rows(train))
    return judged(spark, stored_scores(spark, model, test, threshold=None))


def boosted_rounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation loss of every round that the fit made, and whether the round was kept."""
    train, val, _ = split_parts(spark, sf_dir)
    model = models.train_boosted(train, val, key=F.col(modelling.ROW))
    rows = [(k, round(loss, 9), k <= model.getNumTrees) for k, loss in enumerate(model.losses, 1)]
    return spark.createDataFrame(rows, "round int, val_loss double, kept boolean")


def mlp_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy of both parts by epoch, and whether the state of the epoch was kept."""
    train, val, _ = split_parts(spark, sf_dir)
    model = models.train_mlp(train, val, key=F.col(modelling.ROW), batch_size=step_rows(train))
    history = models.history_frame(spark, model)
    best = models.pick_best_epoch(history).first()["epoch"]
    values = [F.round(c, 6).alias(c) for c in ("train_loss", "val_loss", "train_acc", "val_acc")]
    return history.select("epoch", *values, (F.col("epoch") == best).alias("kept"))


def score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per learner and class: test rows, and how many get another score from what was saved and loaded again.

    The network is saved with its scaler and reads raw rows.
    """
    train, val, test = split_parts(spark, sf_dir)
    fits = {
        "Random Forest": lambda: models.train_forest(small_forest_rows(train), n_estimators=50),
        "Boosted Trees": lambda: models.train_boosted(train, val, rounds=30, key=F.col(modelling.ROW)),
        "Neural Network": lambda: models.train_mlp(train, val, epochs=2, key=F.col(modelling.ROW)),
    }
    out = []
    for name, fit in fits.items():
        model, where = fit(), scratch_path(spark, "model")
        models.save_model(model, where)
        before = models.score(model, test).withColumnRenamed("score", "before").drop("pred")
        both = models.score(models.load_model(where), before)
        counted = both.groupBy(F.col(TARGET).cast("int").alias(TARGET)).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") != F.col("before")).alias("n_other_score")
        )
        out.append(counted.select(F.lit(name).alias("model"), "*"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def searched(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The stored split, and the search over the whole grid."""
    path = stored(spark, sf_dir)
    return path, modelling.search_configs(spark, path)


def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every configuration with its F1 on the validation part, and whether it is its learner's pick."""
    _, table = searched(spark, sf_dir)
    picks = modelling.best_configs(table).select("model", F.col("config").alias("pick"), F.round("best", 6).alias("best_f1"))
    known = [c for c in table.columns if c not in ("f1", "time_s")]
    return table.join(picks, "model").select(
        *known, F.round("f1", 6).alias("f1"), "best_f1", (F.col("config") == F.col("pick")).alias("picked"), (F.col("time_s") > 0).alias("timed")
    )


def best_configs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small search whose picks are stored, read and trained with: the pick, the settings used, metrics on the test part."""
    path, where = stored(spark, sf_dir), scratch_path(spark, "best")
    grid = {
        "forest": ({"n_estimators": 20, "max_depth": 8}, {"n_estimators": 40, "max_depth": 8}),
        "boosted": ({"max_depth": 4, "eta": 0.3}, {"max_depth": 6, "eta": 0.3}),
        "mlp": ({"batch_size": 2048, "lr": 1e-3}, {"batch_size": 8192, "lr": 1e-3}),
    }
    table = modelling.search_configs(spark, path, grid, boosted={"rounds": 20})
    modelling.store_best_configs(table, where)
    used = [(modelling.LEARNERS[k], str(v)) for k, v in modelling.trained_settings(spark, where).items()]
    metrics = modelling.train_and_compare(spark, path, boosted={"rounds": 40}, mlp={"epochs": 3}, best=where)
    picks = run_files.read_best_configs(spark, where).withColumnRenamed("config", "pick")
    rows = picks.join(spark.createDataFrame(used, "model string, settings string"), "model").join(metrics, "model")
    return rows.select("model", "pick", "settings", *[F.round(c, 6).alias(c) for c in METRICS])


METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def comparison_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of every model on the test part."""
    path = stored(spark, sf_dir)
    steps = step_rows(read_split(spark, path, "train"))
    table = modelling.train_and_compare(spark, path, mlp={"batch_size": steps})
    return table.select("model", *[F.round(c, 6).alias(c) for c in METRICS], (F.col("train_time_s") > 0).alias("timed"))


def rule_and_forest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    """Test rows with the decisions of the rule, its limit chosen on the validation part, and of the forest."""
    train, val, test = split_parts(spark, sf_dir)
    limit = evaluation.best_threshold(evaluation.threshold_rule(val, TARGET, "delta_t", -20.0, 80.0, 100))
    scored = stored_scores(spark, models.train_forest(train, n_estimators=100, key=F.col(modelling.ROW)), test)
    return evaluation.rule_and_model(scored, "delta_t", limit, TARGET), limit


def rule_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class: the rule's limit and right rows, which the paired counts must add up to; the model's recall is no less."""
    both, limit = rule_and_forest(spark, sf_dir)
    recall = {c: evaluation.classification_metrics(both, TARGET, c).first()["recall"] for c in ("rule", "model")}
    pairs = evaluation.paired_table(both, TARGET)
    return pairs.select(
        TARGET, "n", F.lit(limit).alias("threshold"), (F.col("both_right") + F.col("only_rule")).alias("rule_right"),
        (F.col("both_right") + F.col("only_rule") + F.col("only_model") + F.col("neither")).alias("n_pairs"),
        F.lit(round(recall["rule"], 9)).alias("rule_recall"), F.lit(recall["model"] >= recall["rule"]).alias("model_keeps_recall"),
    )


def rule_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is right on the same test rows, by class, with both false-alarm rates at equal recall."""
    both, _ = rule_and_forest(spark, sf_dir)
    rate = {c: both.where(F.col(TARGET) == 0).agg(F.round(F.avg(c), 9).alias("r")).first()["r"] for c in ("rule", "model")}
    named = [F.lit(rate[c]).alias(f"{c}_false_alarm_rate") for c in rate]
    return evaluation.paired_table(both, TARGET).select("*", *named)


register("train_forest", "L3 L8", forest_query, TEST_ROWS)
register("train_boosted", "L4 L8", boosted_query, TEST_ROWS)
register("train_mlp", "L5 L8", mlp_query, TEST_ROWS)
register("train_boosted_rounds", "L4", boosted_rounds_query)
register("train_mlp_history", "L5 L13", mlp_history_query)
LEARNERS = "(SELECT unnest(['Random Forest', 'Boosted Trees', 'Neural Network']) AS model)"
register(
    "score",
    "L8 L9",
    score_query,
    sql_with(
        "lab",
        "SELECT model, CAST(c AS INTEGER) AS is_false_alarm, CAST(n_test AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_other_score "
        f"FROM parts CROSS JOIN {LEARNERS}",
        **SIZES,
    ),
)
register("search", "L7 W1", search_query)
register("best_configs", "L7 L10", best_configs_query)
register("compare_models", "L10", comparison_query)
SWEEP = "SELECT CAST(j AS DOUBLE) - 20 AS t FROM generate_series(0, 100) AS s(j)"
register(
    "rule_against_model",
    "L10 L11",
    rule_query,
    sql_with(
        "lab",
        "SELECT CAST(is_false_alarm AS INTEGER) AS is_false_alarm, count(*) AS n, max(t) AS threshold, "
        "count(*) FILTER ((delta_t < t) = (is_false_alarm = 1)) AS rule_right, count(*) AS n_pairs, "
        "(SELECT round(count(*) FILTER (delta_t < t) / count(*), 9) FROM split, pick WHERE split = 'test' AND is_false_alarm = 1) AS rule_recall, "
        "true AS model_keeps_recall FROM split, pick WHERE split = 'test' GROUP BY is_false_alarm",
        **SIZES,
        **NUMBERED,
        swept="SELECT t, count(*) FILTER (is_false_alarm = 1 AND delta_t < t) AS tp, count(*) FILTER (is_false_alarm = 0 AND delta_t < t) AS fp, "
        f"count(*) FILTER (is_false_alarm = 1) AS p FROM split CROSS JOIN ({SWEEP}) WHERE split = 'val' GROUP BY t",
        pick="SELECT t FROM swept ORDER BY 2 * tp / (tp + fp + p) DESC, t LIMIT 1",
    ),
)
register("rule_against_model_pairs", "L10 L11", rule_pairs_query)

# ---- stored vectors ------------------------------------------------------------------------------------

WIDTH, CLASSES = 64, 10


def vector_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = views.table(spark, sf_dir, "embeddings")
    in_train = below(hash32(["vec_id"]), 0.80)
    return rows.where(in_train), rows.where(~in_train)


def fitted_head(spark: SparkSession, sf_dir: str):
    """The test part, and a head whose best epoch on it is kept.

    The stored labels have nothing to do with the vectors; what is learned is which of the first components is largest.
    """
    some = F.slice("embedding", 1, CLASSES)
    largest = (F.array_position(some, F.array_max(some)) - 1).cast("int")
    train, test = (rows.withColumn("label", largest) for rows in vector_parts(spark, sf_dir))
    return test, models.train_head(train, "embedding", "label", WIDTH, CLASSES, test)


def head_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test vectors per label, and whether more of them are told than by always naming the commonest label."""
    test, model = fitted_head(spark, sf_dir)
    judged_rows = model.transform(models.vector_features(test, "embedding", "label"))
    counted = judged_rows.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("_right")
    )
    # One row per label.
    both = counted.agg(F.struct(F.sum("_right").alias("right"), F.max("n").alias("most")).alias("s"))
    return counted.select("label", "n").crossJoin(F.broadcast(both)).select(
        "label", "n", F.col("s.most").alias("n_commonest"), (F.col("s.right") > F.col("s.most")).alias("beats_commonest")
    )


def history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy of a head by epoch, and whether the epoch's state is the model's."""
    test, model = fitted_head(spark, sf_dir)
    history = models.history_frame(spark, model)
    best = models.pick_best_epoch(history).first()
    again, _ = models.loss_and_accuracy(model, models.vector_features(test, "embedding", "label"), "label")
    values = [F.round(c, 6).alias(c) for c in ("train_loss", "val_loss", "train_acc", "val_acc")]
    kept = (F.col("epoch") == best["epoch"]) & F.lit(abs(again - best["val_loss"]) < 1e-9)
    return history.select("epoch", *values, kept.alias("kept"))


IN_TEST = f"NOT ({hash_sql('vec_id')} < {int(0.80 * 2**32)})"
register(
    "train_head",
    "L12",
    head_query,
    "SELECT CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS INTEGER) AS label, count(*) AS n, "
    f"max(count(*)) OVER () AS n_commonest, true AS beats_commonest FROM embeddings WHERE {IN_TEST} GROUP BY 1",
)
register("pick_best_epoch", "L13", history_query)
