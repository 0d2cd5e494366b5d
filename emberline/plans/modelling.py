"""Train, compare and summarise the three classifiers on a stored, split model table."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions.hashing import below, hash32
from emberline.operators.boosting import ALONE
from emberline.operators.models import (
    GRID,
    SEARCH_EPOCHS,
    SEARCH_ROUNDS,
    Candidate,
    compare_models,
    search,
    search_forest,
    side_by_side,
    timed,
    train_boosted,
    train_forest,
    train_mlp,
)
from emberline.operators.run_reports import fastest_within_tolerance
from emberline.operators.sampling import exact_stratified_split, stratified_split
from emberline.schemas import MODEL_COLUMNS, SEARCH_RUNS, TARGET
from emberline.session import scratch_path
from emberline.sources.run_files import path_exists, read_best_configs
from emberline.sources.tables import read_split, write_splits

LEARNERS = {"forest": "Random Forest", "boosted": "Boosted Trees", "mlp": "Neural Network"}
# A stored batch size below the first is taken as the second on a whole training part.
LEAST_BATCH, WHOLE_BATCH = 8192, 32768
# Name of the column that numbers the rows of stored splits.
ROW = "row"


def bounded(train: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` training rows, by a hash of their row number; all of a smaller part.

    The rows are stored: a forest's fit reads its rows several times, the whole part is read once.
    """
    share = most / max(train.count(), 1)
    if share >= 1:
        return train
    path = scratch_path(train.sparkSession, "bounded")
    train.where(below(hash32([ROW]), share)).write.parquet(path)
    return train.sparkSession.read.parquet(path)


def store_splits(
    spark: SparkSession, labelled: DataFrame, keys: Sequence[str], path: str | None = None, exact: bool = True
) -> str:
    """Split by row key and write one folder per part; rows without a label are left out.

    The stored column ``row`` is a hash of the row key, by which later steps deal rows.
    """
    path = path or scratch_path(spark, "splits")
    rows = labelled.where(F.col(TARGET).isNotNull())
    split = exact_stratified_split(rows, keys) if exact else stratified_split(rows, keys)
    write_splits(split.select(*MODEL_COLUMNS, F.xxhash64(*keys).alias(ROW), "split"), path)
    return path


def at_once(train: DataFrame, most: int) -> int:
    """How many fits run side by side: one where each fills the cluster, so that there is one fit's data on disk at a time."""
    return most if train.count() <= ALONE else 1


def train_and_compare(
    spark: SparkSession,
    splits: str,
    forest: dict | None = None,
    boosted: dict | None = None,
    mlp: dict | None = None,
    best: str | None = None,
    forest_rows: int | None = None,
) -> DataFrame:
    """Metrics of forest, boosted trees and network on the test part. Fits of few rows run side by side.

    ``best`` is a file of stored best configurations: they set what the arguments leave open. ``forest_rows`` bounds
    the rows that the forest is fitted on; all else runs over whole parts.
    """
    found = trained_settings(spark, best) if best else {}
    forest, boosted, mlp = ({**found.get(k, {}), **(v or {})} for k, v in (("forest", forest), ("boosted", boosted), ("mlp", mlp)))
    train, val, test = (read_split(spark, splits, s) for s in ("train", "val", "test"))
    key = {"key": F.col(ROW)} if ROW in train.columns else {}
    fits = (
        lambda: train_boosted(train, val, **key, **boosted),
        lambda: train_mlp(train, val, **key, **mlp),
        lambda: train_forest(train if forest_rows is None else bounded(train, forest_rows), **key, **forest),
    )
    (gbt, gbt_time), (net, net_time), (rf, rf_time) = side_by_side([lambda f=f: timed(f) for f in fits], at_once(train, len(fits)))
    return compare_models(
        spark,
        [
            Candidate(LEARNERS["forest"], rf, test, rf_time),
            Candidate(LEARNERS["boosted"], gbt, test, gbt_time),
            Candidate(LEARNERS["mlp"], net, test, net_time, threshold=None),
        ],
    )


def search_configs(
    spark: SparkSession,
    splits: str,
    grid: dict[str, Sequence[dict]] | None = None,
    forest_rows: int | None = None,
    **fixed: dict,
) -> DataFrame:
    """All configurations of the three learners on the stored split, independent fits of few rows side by side.

    ``fixed`` holds settings shared by a learner's configurations, by learner name.
    """
    grid = GRID if grid is None else grid
    train, val = (read_split(spark, splits, s) for s in ("train", "val"))
    key = {"key": F.col(ROW)} if ROW in train.columns else {}
    some = train if forest_rows is None else bounded(train, forest_rows)
    together = at_once(train, 4)
    boosted = {"rounds": SEARCH_ROUNDS, **key, **fixed.get("boosted", {})}
    mlp = {"epochs": SEARCH_EPOCHS, **key, **fixed.get("mlp", {})}
    work = {
        "forest": lambda: search_forest(grid["forest"], some, val, at_once=together, **key, **fixed.get("forest", {})),
        "boosted": lambda: search(LEARNERS["boosted"], grid["boosted"], lambda c: train_boosted(train, **boosted, **c), val, at_once=together),
        "mlp": lambda: search(LEARNERS["mlp"], grid["mlp"], lambda c: train_mlp(train, **mlp, **c), val, threshold=None, at_once=together),
    }
    found = side_by_side([w for k, w in work.items() if k in grid], min(together, len(work)))
    return spark.createDataFrame([r for rows in found for r in rows], SEARCH_RUNS)


def best_configs(table: DataFrame, tolerance: float = 0.01) -> DataFrame:
    return fastest_within_tolerance(table, tolerance)


def store_best_configs(table: DataFrame, path: str, tolerance: float = 0.01) -> None:
    """The best configuration of every learner as one document ``{learner: configuration}``."""
    picks = {r["model"]: r["config"] for r in best_configs(table, tolerance).select("model", "config").collect()}
    document = json.dumps(dict(sorted(picks.items())))
    table.sparkSession.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def trained_settings(spark: SparkSession, path: str) -> dict[str, dict]:
    """Stored best configurations as settings by learner; nothing where there is no such file.

    A batch size that is too small for a whole training part is replaced.
    """
    if not path_exists(spark, path):
        return {}
    stored = {r["model"]: ast.literal_eval(r["config"]) for r in read_best_configs(spark, path).collect()}
    found = {k: dict(stored[name]) for k, name in LEARNERS.items() if name in stored}
    if found.get("mlp", {}).get("batch_size", LEAST_BATCH) < LEAST_BATCH:
        found["mlp"]["batch_size"] = WHOLE_BATCH
    return found
