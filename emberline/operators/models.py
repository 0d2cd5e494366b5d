"""Classifiers: preparation, training, search, scoring, comparison.

Forest, boosted trees and network are this package's own distributed fits, as Spark ML models.
Training frames should be stored tables (see ``plans.modelling``): the learners read them more than once, and a
stored table survives lost executors without recomputing the preparation.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberline.operators.boosting import BoostedModel, fit_boosted
from emberline.operators.evaluation import classification_metrics, roc_auc
from emberline.operators.forest import ForestModel, fit_forest
from emberline.operators.network import NetworkModel, fit_network, history_rows
from emberline.operators.preparation import fit_scaler
from emberline.schemas import MODEL_METRICS, PREDICTORS, SEARCH_RUNS, TARGET

FEATURES = "features"
# Rows of a partition that Spark's own learners are given.
PART_ROWS = 65_536
WEIGHT = "weight"


def assemble(df: DataFrame, predictors: Sequence[str] = PREDICTORS) -> DataFrame:
    """Feature vector of the predictors; a null or NaN among them is an error."""
    return VectorAssembler(inputCols=list(predictors), outputCol=FEATURES, handleInvalid="error").transform(df)


def standard_moments(train: DataFrame, predictors: Sequence[str] = PREDICTORS) -> DataFrame:
    """Mean and population deviation of every predictor, one row, from the training part only."""
    return train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in predictors],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in predictors],
    )


def standardise(df: DataFrame, train: DataFrame, predictors: Sequence[str] = PREDICTORS) -> DataFrame:
    """z-scores by the moments of ``train``; a constant column is centred only."""
    moments = standard_moments(train, predictors)
    fitted = df.withColumn("_m", moments.select(F.struct(*moments.columns)).scalar())

    def scaled(c: str) -> Column:
        spread = F.col(f"_m.std_{c}")
        return (F.col(c) - F.col(f"_m.mean_{c}")) / F.when(spread > 0, spread).otherwise(1.0)

    return fitted.withColumns({c: scaled(c) for c in predictors}).drop("_m")


def class_weights(df: DataFrame, target: str = TARGET, mode: str = "balanced") -> DataFrame:
    """Weight per class: ``balanced`` gives n / (classes * n_class), ``positive`` weighs class 1 only."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    if mode == "balanced":
        both = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
        weight = F.col("_all.rows") / (F.col("_all.classes") * F.col("n"))
    elif mode == "positive":
        both = counts.agg(
            F.struct(
                F.sum(F.when(F.col(target) == 0, F.col("n")).otherwise(0)).alias("neg"),
                F.sum(F.when(F.col(target) == 1, F.col("n")).otherwise(0)).alias("pos"),
            )
        ).scalar()
        positive = F.col("_all.neg") / F.greatest(F.col("_all.pos"), F.lit(1))
        weight = F.when(F.col(target) == 1, positive).otherwise(F.lit(1.0))
    else:
        raise ValueError(f"unknown weight mode: {mode}")
    return counts.withColumn("_all", both).select(target, "n", weight.alias(WEIGHT))


def with_class_weight(
    df: DataFrame, target: str = TARGET, mode: str = "balanced", fitted_on: DataFrame | None = None
) -> DataFrame:
    """Add the weight of the row's class for a 0/1 target, by the class sizes of ``fitted_on`` or itself."""
    weights = class_weights(df if fitted_on is None else fitted_on, target, mode)
    of = weights.agg(
        F.struct(
            F.max(F.when(F.col(target) == 0, F.col(WEIGHT))).alias("zero"),
            F.max(F.when(F.col(target) == 1, F.col(WEIGHT))).alias("one"),
        )
    ).scalar()
    chosen = F.when(F.col(target) == 1, F.col("_w.one")).otherwise(F.col("_w.zero"))
    return df.withColumn("_w", of).withColumn(WEIGHT, chosen).drop("_w")


def laid_out(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows placed and ordered by their content, so that a fit does not depend on files or cores.

    Without ``parts`` there is a partition for every ``PART_ROWS`` rows.
    """
    parts = parts or max(1, -(-df.count() // PART_ROWS))
    return df.repartition(parts, *columns).sortWithinPartitions(*columns)


# ---- learners -------------------------------------------------------------------------------

# Default settings of the three learners.
FOREST = {"n_estimators": 300, "max_depth": 16}
BOOSTED = {"max_depth": 8, "eta": 0.1, "rounds": 500, "subsample": 0.8, "colsample": 0.8, "patience": 25}
# Hidden units, dropout, epochs, rows of a step and learning rate of a head.
HEAD = {"hidden": (64,), "dropped": (0.3,), "epochs": 10, "batch_size": 32, "lr": 1e-3}

# Configurations tried by the search, and the boosting rounds and network epochs there.
GRID = {
    "forest": (
        {"n_estimators": 100, "max_depth": 8},
        {"n_estimators": 100, "max_depth": 16},
        {"n_estimators": 300, "max_depth": 16},
        {"n_estimators": 300, "max_depth": 24},
    ),
    "boosted": (
        {"max_depth": 4, "eta": 0.3},
        {"max_depth": 8, "eta": 0.1},
        {"max_depth": 8, "eta": 0.3},
        {"max_depth": 12, "eta": 0.1},
    ),
    "mlp": (
        {"batch_size": 2048, "lr": 1e-3},
        {"batch_size": 8192, "lr": 1e-3},
        {"batch_size": 8192, "lr": 5e-4},
        {"batch_size": 32768, "lr": 1e-3},
    ),
}
SEARCH_ROUNDS = 200
SEARCH_EPOCHS = 3


class Forest(Estimator):
    """A random forest on the model's target, from raw rows; ``weighted`` balances its classes."""

    def __init__(self, n_estimators: int, max_depth: int, weighted: bool, seed: int, predictors: Sequence[str], key: Column | None):
        super().__init__()
        self.settings = {"n_estimators": n_estimators, "max_depth": max_depth, "seed": seed, "key": key}
        self.weighted, self.predictors = weighted, predictors

    def getNumTrees(self) -> int:
        return self.settings["n_estimators"]

    def getMaxDepth(self) -> int:
        return self.settings["max_depth"]

    def _fit(self, dataset: DataFrame) -> ForestModel:
        found = {r[TARGET]: r[WEIGHT] for r in class_weights(dataset, mode="balanced").collect()} if self.weighted else {}
        return fit_forest(dataset, self.predictors, TARGET, weights=(found.get(0, 1.0), found.get(1, 1.0)), **self.settings)


def forest(
    n_estimators: int = 300,
    max_depth: int = 16,
    weighted: bool = True,
    seed: int = 42,
    predictors: Sequence[str] = PREDICTORS,
    key: Column | None = None,
) -> Estimator:
    return Forest(n_estimators, max_depth, weighted, seed, predictors, key)


def train_forest(train: DataFrame, predictors: Sequence[str] = PREDICTORS, **settings) -> Model:
    return forest(**{**FOREST, "predictors": predictors, **settings}).fit(train)


def train_boosted(
    train: DataFrame, val: DataFrame | None = None, predictors: Sequence[str] = PREDICTORS, **settings
) -> BoostedModel:
    """Boosted trees in one running fit; ``val`` decides when it ends and how many rounds are kept."""
    return fit_boosted(train, val, predictors, TARGET, **{**BOOSTED, **settings})


def train_mlp(
    train: DataFrame, val: DataFrame | None = None, predictors: Sequence[str] = PREDICTORS, **settings
) -> PipelineModel:
    """Network with its own scaler: the pipeline takes raw rows, and is saved and loaded whole."""
    scaler = fit_scaler(train, predictors)
    names = scaler.outputs()
    scaled_val = None if val is None else scaler.transform(val)
    network = fit_network(scaler.transform(train), scaled_val, names, TARGET, **settings)
    return PipelineModel([scaler, VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="error"), network])


def network_of(model: Model) -> NetworkModel:
    """The network of a pipeline."""
    return next(s for s in model.stages if isinstance(s, NetworkModel))


def history_frame(spark: SparkSession, model: Model) -> DataFrame:
    """Loss and accuracy on both parts after every epoch of a network's fit."""
    rows = history_rows(network_of(model) if isinstance(model, PipelineModel) else model)
    return spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double, train_acc double, val_acc double")


def score(
    model: Model, df: DataFrame, predictors: Sequence[str] = PREDICTORS, threshold: float | None = 0.5
) -> DataFrame:
    """Add ``score`` (probability of class 1) and ``pred``; ``threshold=None`` takes the likelier class.

    A pipeline prepares the rows itself.
    """
    scored = model.transform(df if isinstance(model, PipelineModel) else assemble(df, predictors))
    likely = vector_to_array("probability")[1]
    pred = F.col("prediction") if threshold is None else (likely >= threshold)
    return scored.select(*df.columns, likely.alias("score"), pred.cast("int").alias("pred"))


def save_model(model: Model, path: str) -> None:
    """A model, or a pipeline with its preparation."""
    (model if isinstance(model, PipelineModel) else PipelineModel([model])).write().overwrite().save(path)


def load_model(path: str) -> Model:
    """What was saved: a pipeline where preparation was saved with the model, the model alone elsewhere."""
    found = PipelineModel.load(path)
    return found if len(found.stages) > 1 else found.stages[0]


# ---- comparison and search --------------------------------------------------------------------


@dataclass
class Candidate:
    """A trained model and the rows to judge it on."""

    name: str
    model: Model
    test: DataFrame
    train_time_s: float
    threshold: float | None = 0.5
    predictors: Sequence[str] = field(default=PREDICTORS)


def timed(work: Callable):
    start = time.perf_counter()
    result = work()
    return result, time.perf_counter() - start


def compare_models(spark: SparkSession, candidates: Iterable[Candidate], target: str = TARGET) -> DataFrame:
    """One row of metrics per model; only those rows pass through the driver.

    Scores are taken once per model and stored in the shared folder, where both metric queries read
    them; the time of that pass is the inference time.
    """
    from emberline.session import scratch_path

    rows = []
    for c in candidates:
        where = scratch_path(spark, "scores")
        scored = score(c.model, c.test, c.predictors, c.threshold).select(target, "score", "pred")
        _, infer = timed(lambda: scored.write.parquet(where))
        stored = spark.read.parquet(where)
        m = classification_metrics(stored, target).first()
        auc = roc_auc(stored, target).first()["roc_auc"]
        rows.append(
            (c.name, m["accuracy"], m["precision"], m["recall"], m["f1"], auc, c.train_time_s, infer, None, None, None)
        )
    return spark.createDataFrame(rows, MODEL_METRICS)


def side_by_side(work: Sequence[Callable], at_once: int) -> list:
    """Results of independent fits; their Spark jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(SparkSession.active())(w)) for w in work]]


def validation_f1(scored: DataFrame) -> float:
    return classification_metrics(scored, TARGET).first()["f1"]


def search_row(model: str, config: dict, f1: float, seconds: float) -> tuple:
    known = [f.name for f in SEARCH_RUNS][4:]
    return (model, str(config), f1, seconds, *[float(config[k]) if k in config else None for k in known])


def search(
    model: str,
    grid: Iterable[dict],
    fit: Callable[[dict], Model],
    val: DataFrame,
    predictors: Sequence[str] = PREDICTORS,
    threshold: float | None = 0.5,
    at_once: int = 4,
) -> list[tuple]:
    """F1 on a fixed validation part and the training time for every configuration, fitted side by side."""

    def tried(config: dict) -> tuple:
        trained, seconds = timed(lambda: fit(config))
        return search_row(model, config, validation_f1(score(trained, val, predictors, threshold)), seconds)

    return side_by_side([lambda c=c: tried(c) for c in grid], at_once)


def search_forest(
    grid: Sequence[dict], train: DataFrame, val: DataFrame, predictors: Sequence[str] = PREDICTORS, at_once: int = 4, **settings
) -> list[tuple]:
    """The search over forests, staged: forests of one depth grow from each other.

    The trees of a smaller forest are the first of the next larger one of that depth; only the trees in between
    are fitted, with a seed of their own. A forest's probability is the mean of its stages' by number of trees, and
    its time the sum of theirs.
    """
    seed = settings.pop("seed", 42)

    def staged(depth: int) -> list[tuple]:
        sizes = sorted({c["n_estimators"] for c in grid if c["max_depth"] == depth})
        scored, total, done, rows = assemble(val, predictors).withColumn("_sum", F.lit(0.0)), 0.0, 0, {}
        for stage, size in enumerate(sizes):
            fit = lambda: train_forest(train, predictors, n_estimators=size - done, max_depth=depth, seed=seed + stage, **settings)  # noqa: B023
            model, seconds = timed(fit)
            total += seconds
            added = model.transform(scored).withColumn("_new", F.col("_sum") + (size - done) * vector_to_array("probability")[1])
            scored = added.select(*[c for c in scored.columns if c != "_sum"], F.col("_new").alias("_sum"))
            done = size
            share = F.col("_sum") / size
            rows[size] = validation_f1(scored.withColumns({"score": share, "pred": (share >= 0.5).cast("int")})), total
        return [search_row("Random Forest", c, *rows[c["n_estimators"]]) for c in grid if c["max_depth"] == depth]

    return [r for some in side_by_side([lambda d=d: staged(d) for d in sorted({c["max_depth"] for c in grid})], at_once) for r in some]


# ---- heads on stored feature vectors, training history ------------------------------------------


def vector_features(df: DataFrame, vectors: str, label: str) -> DataFrame:
    """Rows (features, label) from an array column of frozen features."""
    return df.select(
        array_to_vector(F.transform(vectors, lambda x: x.cast("double"))).alias(FEATURES),
        F.col(label).cast("double").alias(label),
    )


def vector_columns(df: DataFrame, vectors: str, width: int, label: str) -> DataFrame:
    """One column per component, and the label."""
    return df.select(*[F.col(vectors)[k].cast("double").alias(f"v{k}") for k in range(width)], F.col(label))


def train_head(
    df: DataFrame, vectors: str, label: str, width: int, classes: int, val: DataFrame | None = None, seed: int = 42, **settings
) -> NetworkModel:
    """Small trained head on a frozen extractor: one hidden layer with dropout, or with ``hidden=()`` a linear one."""
    settings = {**HEAD, **settings}
    if not settings["hidden"]:
        settings["dropped"] = ()
    normed = (False,) * len(settings["hidden"])
    parts = [None if d is None else vector_columns(d, vectors, width, label) for d in (df, val)]
    return fit_network(*parts, [f"v{k}" for k in range(width)], label, classes=classes, normed=normed, seed=seed, **settings)


def loss_and_accuracy(model: Model, rows: DataFrame, label: str) -> tuple[float, float]:
    likely = vector_to_array("probability")[F.col(label).cast("int")]
    got = model.transform(rows).agg(
        F.avg(-F.ln(F.greatest(likely, F.lit(1e-15)))).alias("loss"),
        F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
    ).first()
    return got["loss"], got["accuracy"]


def pick_best_epoch(history: DataFrame) -> DataFrame:
    """The epoch with the lowest validation loss; the first one where losses are equal."""
    return history.orderBy("val_loss", "epoch").limit(1)
