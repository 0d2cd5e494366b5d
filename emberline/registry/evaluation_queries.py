"""Queries over predictions derived from detections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberline.operators import evaluation
from emberline.registry.book import register
from emberline.registry.detection_queries import rounded
from emberline.registry.views import predictions, sql_with


def on_predictions(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(predictions(spark, sf_dir))


CELLS = {
    "cells": "SELECT count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp, "
    "count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn FROM pred"
}
register(
    "confusion_matrix",
    "A26",
    on_predictions(evaluation.confusion_matrix),
    sql_with(
        "pred",
        "SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cells UNION ALL SELECT 0, 1, fp FROM cells "
        "UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells",
        **CELLS,
    ),
)
METRICS = ("accuracy", "precision", "recall", "f1")
register(
    "classification_metrics",
    "A27",
    on_predictions(lambda d: rounded(evaluation.classification_metrics(d), 9, *METRICS)),
    sql_with(
        "pred",
        "SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision, "
        "round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM cells",
        **CELLS,
    ),
)
register(
    "classification_report",
    "A28",
    on_predictions(lambda d: rounded(evaluation.classification_report(d), 9, "precision", "recall", "f1")),
    sql_with(
        "pred",
        "SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM per "
        "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), "
        "CAST(sum(support) AS BIGINT) FROM per "
        "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), "
        "round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), "
        "CAST(sum(support) AS BIGINT) FROM per",
        **CELLS,
        per="SELECT '0' AS label, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1, "
        "tn + fp AS support FROM cells UNION ALL "
        "SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cells",
    ),
)


def curve_sql(score: str) -> dict[str, str]:
    return {
        "grp": f"SELECT {score} AS score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM pred GROUP BY 1",
        "cum": "SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, "
        "CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM grp WINDOW w AS (ORDER BY score DESC)",
    }


register(
    "cumulative_rates",
    "W3",
    on_predictions(
        lambda d: rounded(
            evaluation.cumulative_rates(d).select("score", "pos", "neg", "tp", "fp", "tpr", "fpr"), 9, "tpr", "fpr"
        )
    ),
    sql_with(
        "pred", "SELECT score, pos, neg, tp, fp, round(tp / p, 9) AS tpr, round(fp / n, 9) AS fpr FROM cum", **curve_sql("score")
    ),
)
AUC = "SELECT round(sum(neg * (tp - pos / 2)) / (max(p)::DOUBLE * max(n)), 9) AS roc_auc FROM cum"
register(
    "roc_auc",
    "A30",
    on_predictions(lambda d: rounded(evaluation.roc_auc(d), 9, "roc_auc")),
    sql_with("pred", AUC, **curve_sql("score")),
)
register(
    "roc_auc_few_ties",
    "A30",
    on_predictions(lambda d: rounded(evaluation.roc_auc(d, score="fine_score"), 9, "roc_auc")),
    sql_with("pred", AUC, **curve_sql("fine_score")),
)


def roc_sql(score: str, points: int, corners: bool) -> str:
    steps = {
        **curve_sql(score),
        "flag": "SELECT *, row_number() OVER w = 1 OR lead(pos) OVER w IS NULL OR lead(pos) OVER w <> pos "
        "OR lead(neg) OVER w <> neg AS keep FROM cum WINDOW w AS (ORDER BY score DESC)",
        "num": "SELECT score, tp / p AS tpr, fp / n AS fpr, row_number() OVER (ORDER BY score DESC) AS i, count(*) OVER () AS m "
        f"FROM flag {'WHERE keep' if corners else ''}",
        "allp": "SELECT CAST(0 AS BIGINT) AS i, NULL::DOUBLE AS score, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, max(m) AS m FROM num "
        "UNION ALL SELECT i, score, fpr, tpr, m FROM num",
        "pick": f"SELECT DISTINCT (j * (SELECT max(m) FROM num)) // {points - 1} AS i FROM generate_series(0, {points - 1}) AS s(j)",
    }
    return sql_with(
        "pred",
        'SELECT CAST(i AS BIGINT) AS "index", score AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM allp '
        f"WHERE m < {points} OR i IN (SELECT i FROM pick)",
        **steps,
    )


register(
    "roc_points",
    "A29",
    on_predictions(lambda d: rounded(evaluation.roc_points(d), 9, "fpr", "tpr")),
    roc_sql("score", 2000, True),
)
register(
    "roc_points_thinned",
    "A29",
    on_predictions(lambda d: rounded(evaluation.roc_points(d, score="fine_score"), 9, "fpr", "tpr")),
    roc_sql("fine_score", 2000, True),
)
register(
    "roc_points_all_scores",
    "A29",
    on_predictions(
        lambda d: rounded(
            evaluation.roc_points(d, score="fine_score", points=500, drop_intermediate=False), 9, "fpr", "tpr"
        )
    ),
    roc_sql("fine_score", 500, False),
)
RULE = ("precision", "recall", "false_alarm_rate", "f1")
register(
    "threshold_rule",
    "L11",
    on_predictions(lambda d: rounded(evaluation.threshold_rule(d, "y", "delta_t", -20.0, 80.0, 100), 9, *RULE)),
    sql_with(
        "pred",
        "SELECT t AS threshold, tp, fp, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision, "
        "round(tp / p, 9) AS recall, round(fp / n, 9) AS false_alarm_rate, round(2 * tp / (tp + fp + p), 9) AS f1 FROM swept",
        swept="SELECT t, count(*) FILTER (y = 1 AND delta_t < t) AS tp, count(*) FILTER (y = 0 AND delta_t < t) AS fp, "
        "count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n "
        "FROM pred CROSS JOIN (SELECT CAST(j AS DOUBLE) - 20 AS t FROM generate_series(0, 100) AS s(j)) GROUP BY t",
    ),
)
