import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import evaluation

SCHEMA = "y int, score double, pred int"


def made(spark, n=1500, seed=3, levels=None):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        s = rng.gauss(y, 1.0)
        # A third of the rows share one score.
        s = 0.5 if i % 3 == 0 else s if levels is None else round(s * levels) / levels
        data.append((y, s, int(s > 0.5)))
    return data, spark.createDataFrame(data, SCHEMA)


def curve(data):
    """False and true positives per distinct score, from high to low."""
    scores = sorted({s for _, s, _ in data}, reverse=True)
    y = np.array([d[0] for d in data])
    s = np.array([d[1] for d in data])
    fps = np.array([((s >= t) & (y == 0)).sum() for t in scores])
    tps = np.array([((s >= t) & (y == 1)).sum() for t in scores])
    return np.array(scores), fps, tps


def pair_auc(data):
    pos = np.array([s for y, s, _ in data if y == 1])
    neg = np.array([s for y, s, _ in data if y == 0])
    diff = pos[:, None] - neg[None, :]
    return ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size


@pytest.mark.parametrize("levels", [None, 4])
@pytest.mark.parametrize("ranges", [2, 30])
def test_auc_counts_pairs(spark, levels, ranges):
    data, df = made(spark, levels=levels)
    got = evaluation.roc_auc(df, ranges=ranges).first().roc_auc
    assert got == pytest.approx(pair_auc(data), abs=1e-12)
    turned = evaluation.roc_auc(df.withColumn("score", -F.col("score")), ranges=ranges).first().roc_auc
    assert got + turned == pytest.approx(1.0)


def test_auc_needs_both_classes(spark):
    assert evaluation.roc_auc(spark.createDataFrame([(1, 0.3, 1), (1, 0.4, 1)], SCHEMA)).first().roc_auc is None
    assert evaluation.roc_auc(spark.createDataFrame([], SCHEMA)).first().roc_auc is None


@pytest.mark.parametrize("ranges", [2, 17])
def test_cumulative_counts(spark, ranges):
    data, df = made(spark, levels=10)
    scores, fps, tps = curve(data)
    got = evaluation.cumulative_rates(df, ranges=ranges).orderBy(F.desc("score")).collect()
    assert [r.score for r in got] == list(scores)
    assert [(r.fp, r.tp) for r in got] == list(zip(fps, tps))


@pytest.mark.parametrize("levels, points", [(3, 2000), (None, 2000), (None, 40)])
def test_roc_points_follow_the_chart(spark, levels, points):
    data, df = made(spark, levels=levels)
    scores, fps, tps = curve(data)
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    fpr = np.r_[0, fps[keep]] / fps[-1]
    tpr = np.r_[0, tps[keep]] / tps[-1]
    picked = range(len(fpr)) if len(fpr) <= points else sorted({j * (len(fpr) - 1) // (points - 1) for j in range(points)})
    got = evaluation.roc_points(df, points=points, ranges=6).orderBy("index").collect()
    assert [r["index"] for r in got] == list(picked)
    assert [r.fpr for r in got] == pytest.approx([fpr[i] for i in picked])
    assert [r.tpr for r in got] == pytest.approx([tpr[i] for i in picked])
    assert (got[0].fpr, got[0].tpr, got[0].threshold) == (0.0, 0.0, None)
    assert (got[-1].fpr, got[-1].tpr) == (1.0, 1.0)
    assert len(got) <= points


def test_confusion_cells_sum(spark):
    data, df = made(spark)
    got = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(df).collect()}
    assert sum(got.values()) == len(data)
    assert got[1, 1] == sum(y == p == 1 for y, _, p in data)
    none = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(df.limit(0)).collect()}
    assert none == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (0, 0.2, 0)], SCHEMA)
    assert tuple(evaluation.classification_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)


def test_report_means(spark):
    df = spark.createDataFrame([(0, 0.0, 0)] * 6 + [(0, 0.0, 1)] * 2 + [(1, 0.0, 1)] * 2 + [(1, 0.0, 0)], SCHEMA)
    got = {r.label: r for r in evaluation.classification_report(df).collect()}
    assert got["0"].precision == pytest.approx(6 / 7) and got["0"].support == 8
    assert got["1"].recall == pytest.approx(2 / 3) and got["1"].support == 3
    assert got["macro avg"].precision == pytest.approx((6 / 7 + 0.5) / 2)
    assert got["weighted avg"].recall == pytest.approx((6 / 8 * 8 + 2 / 3 * 3) / 11)


def test_threshold_rule_is_a_plain_comparison(spark):
    data, df = made(spark)
    got = evaluation.threshold_rule(df, "y", "score", -1.0, 1.0, 8).orderBy("threshold").collect()
    assert len(got) == 9
    for r in got:
        assert r.tp == sum(y == 1 and s < r.threshold for y, s, _ in data)
        assert r.fp == sum(y == 0 and s < r.threshold for y, s, _ in data)


def test_positive_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,), (0,)], "y int")
    assert evaluation.positive_weight(df, "y").first()[0] == 3.0
