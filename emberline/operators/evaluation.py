"""Quality of predictions: confusion counts, reports, ROC curves, exact AUC, threshold rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from emberline.operators.ranking import with_value_range


def positive_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive; a table without positives divides by one."""
    positives = F.count_if(F.col(target) == 1)
    return df.agg((F.count_if(F.col(target) == 0) / F.greatest(positives, F.lit(1))).alias("positive_weight"))


def _cells(y: str, pred: str) -> list[Column]:
    yes, no = F.col(y) == 1, F.col(y) == 0
    hit, miss = F.col(pred) == 1, F.col(pred) == 0
    return [
        F.count_if(yes & hit).alias("tp"),
        F.count_if(no & hit).alias("fp"),
        F.count_if(yes & miss).alias("fn"),
        F.count_if(no & miss).alias("tn"),
    ]


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Four rows (actual, predicted, n), zero counts included; one pass."""
    cell = lambda a, p, c: F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
    cells = F.array(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))
    return df.agg(*_cells(y, pred)).select(F.inline(cells))


def ratio(part: Column, whole: Column) -> Column:
    """Zero where undefined."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    return [
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def classification_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 from one pass over the rows."""
    return df.agg(*_cells(y, pred)).select(*rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, with the plain and the weighted mean."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def entry(name: str, hit: Column, wrong: Column, lost: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + lost).alias("recall"),
            ratio(2 * hit, 2 * hit + wrong + lost).alias("f1"),
            (hit + lost).alias("support"),
        )

    both = df.agg(*_cells(y, pred)).select(entry("0", tn, fn, fp).alias("a"), entry("1", tp, fp, fn).alias("b"))
    support = F.col("a.support") + F.col("b.support")

    def mean(name: str, weighted: bool) -> Column:
        def value(metric: str) -> Column:
            first, second = F.col(f"a.{metric}"), F.col(f"b.{metric}")
            if not weighted:
                return (first + second) / 2
            return ratio(first * F.col("a.support") + second * F.col("b.support"), support)

        return F.struct(
            F.lit(name).alias("label"),
            *[value(m).alias(m) for m in ("precision", "recall", "f1")],
            support.alias("support"),
        )

    rows = F.array(F.col("a"), F.col("b"), mean("macro avg", False), mean("weighted avg", True))
    return both.select(F.inline(rows))


def score_counts(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score: ties are merged before anything is ordered."""
    return (
        df.where(F.col(y).isin(0, 1) & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )


def _curve(df: DataFrame, y: str, score: str, ranges: int | None) -> DataFrame:
    """Distinct scores from high to low with running counts.

    What crosses a value range, the counts so far, comes from one small table with a row per range, so the scores are
    shuffled by range once.
    """
    counted = score_counts(df, y, score).withColumn("_down", -F.col("score"))
    ranged = with_value_range(counted, "_down", ["pos", "neg"], ranges)
    cells = ranged.groupBy("_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # One row per value range meets in these windows.
    order = Window.orderBy("_range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0).cast("bigint")
    borders = cells.select(
        "_range",
        F.coalesce(F.sum("_pos").over(before), zero).alias("_pos_before"),
        F.coalesce(F.sum("_neg").over(before), zero).alias("_neg_before"),
        F.sum("_pos").over(whole).alias("total_pos"),
        F.sum("_neg").over(whole).alias("total_neg"),
    )
    inside = Window.partitionBy("_range").orderBy("_down")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(borders, "_range").select(
        "_range",
        "_down",
        "score",
        "pos",
        "neg",
        (F.col("_pos_before") + F.sum("pos").over(upto)).alias("tp"),
        (F.col("_neg_before") + F.sum("neg").over(upto)).alias("fp"),
        "total_pos",
        "total_neg",
    )


def _rate(count: str, total: str) -> Column:
    return F.when(F.col(total) > 0, F.col(count) / F.col(total))


def cumulative_rates(df: DataFrame, y: str = "y", score: str = "score", ranges: int | None = None) -> DataFrame:
    """Per distinct score: true and false positives when everything at or above it is called positive."""
    return _curve(df, y, score, ranges).select(
        "score",
        "pos",
        "neg",
        "tp",
        "fp",
        _rate("tp", "total_pos").alias("tpr"),
        _rate("fp", "total_neg").alias("fpr"),
        "total_pos",
        "total_neg",
    )


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is absent."""
    rows = cumulative_rates(df, y, score, ranges)
    above = F.col("tp") - F.col("pos") / 2
    area = F.sum(F.col("neg") * above.cast("double"))
    pairs = F.max("total_pos").cast("double") * F.max("total_neg")
    return rows.agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))


def _numbered_points(df: DataFrame, y: str, score: str, corners: bool, ranges: int | None) -> DataFrame:
    """(index, threshold, fpr, tpr, last): the points of the curve, numbered from 1, from high to low scores.

    Points are all distinct scores, or with ``corners`` the first one and those where the curve bends: on a straight
    line the next score adds the same counts as this one. Scores are shuffled by range once; running counts and numbers
    are read off the same sorted rows, and one small row per range says what was before and what follows.
    """
    counted = score_counts(df, y, score).select((-F.col("score")).alias("_down"), "pos", "neg")
    ranged = with_value_range(counted, "_down", ["pos", "neg"], ranges)
    step = F.struct("pos", "neg")
    inside = Window.partitionBy("_range").orderBy("_down")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The smallest value has range 0. Whether a range's last score is a corner depends on the next range.
    start = (F.col("_range") == 0) & (F.row_number().over(inside) == 1)
    following = F.lead(step).over(inside)
    local = ranged.withColumns(
        {
            "_tp": F.sum("pos").over(upto),
            "_fp": F.sum("neg").over(upto),
            "_point": (start | (following.isNotNull() & (following != step))) if corners else F.lit(True),
            "_final": following.isNull(),
        }
    ).withColumn("_at", F.sum(F.col("_point").cast("bigint")).over(upto))
    cells = local.groupBy("_range").agg(
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.min_by(step, "_down").alias("_head"),
        F.max_by(step, "_down").alias("_tail"), F.max_by("_point", "_down").alias("_known"), F.max("_at").alias("_inner"),
    )
    # One row per value range meets in these windows.
    order, whole = Window.orderBy("_range"), Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = F.lead("_head").over(order)
    turned = cells.withColumn("_more", ~F.col("_known") & (after.isNull() | (after != F.col("_tail"))))
    points = F.col("_inner") + F.col("_more").cast("bigint")
    zero = F.lit(0).cast("bigint")
    borders = turned.select(
        "_range",
        "_more",
        F.coalesce(F.sum("_pos").over(before), zero).alias("_pos_before"),
        F.coalesce(F.sum("_neg").over(before), zero).alias("_neg_before"),
        F.coalesce(F.sum(points).over(before), zero).alias("_before"),
        F.sum("_pos").over(whole).alias("total_pos"),
        F.sum("_neg").over(whole).alias("total_neg"),
        F.sum(points).over(whole).alias("last"),
    )
    extra = F.col("_final") & F.col("_more")
    return local.join(borders, "_range").where(F.col("_point") | extra).select(
        (F.col("_before") + F.col("_at") + extra.cast("bigint")).alias("index"),
        (-F.col("_down")).alias("threshold"),
        F.when(F.col("total_neg") > 0, (F.col("_neg_before") + F.col("_fp")) / F.col("total_neg")).alias("fpr"),
        F.when(F.col("total_pos") > 0, (F.col("_pos_before") + F.col("_tp")) / F.col("total_pos")).alias("tpr"),
        "last",
    )


def roc_points(
    df: DataFrame,
    y: str = "y",
    score: str = "score",
    points: int = 2000,
    drop_intermediate: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """ROC curve for a chart: starts at (0, 0) with a null threshold, then one point per score.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours. Of the rest
    at most ``points`` evenly spaced ones are kept, first and last included.
    """
    numbered = _numbered_points(df, y, score, drop_intermediate, ranges)
    chosen = _evenly_spaced(F.col("index"), F.col("last"), points)
    own = F.struct("index", "threshold", "fpr", "tpr")
    origin = F.struct(
        F.lit(0).cast("bigint").alias("index"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    # The first row also gives the origin, which is always among the points.
    first = F.col("index") == 1
    given = F.when(first & chosen, F.array(origin, own)).when(first, F.array(origin)).otherwise(F.array(own))
    return numbered.where(chosen | first).select(F.inline(given))


def _evenly_spaced(index: Column, last: Column, points: int) -> Column:
    """Is ``index`` one of floor(j * last / (points - 1)) for j = 0 .. points - 1?"""
    gaps = F.lit(points - 1).cast("bigint")
    j = F.call_function("div", index * gaps + last - 1, F.greatest(last, F.lit(1)))
    return (last < points) | (F.call_function("div", j * last, gaps) == index)


def threshold_rule(df: DataFrame, y: str, col: str, low: float, high: float, steps: int) -> DataFrame:
    """One-variable rule ``col < t`` for evenly spaced ``t``: the baseline a model has to beat.

    Rows are counted per step first (one pass, one small shuffle), the sweep then adds the counts up.
    """
    step = F.floor((F.col(col) - low) * steps / (high - low))
    # NaN is below no threshold.
    at = F.when(F.isnan(col), steps).otherwise(F.least(F.greatest(step, F.lit(-1)), F.lit(steps)))
    counted = (
        df.where(F.col(y).isin(0, 1) & F.col(col).isNotNull())
        .groupBy(at.cast("int").alias("_at"))
        .agg(F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg"))
    )
    domain = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("_at"))
    # steps + 2 rows from here on.
    filled = domain.join(counted, "_at", "left").na.fill(0, ["_pos", "_neg"])
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    tp = F.coalesce(F.sum("_pos").over(before), F.lit(0)).alias("tp")
    fp = F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("fp")
    swept = filled.select(
        "_at", tp, fp, F.sum("_pos").over(whole).alias("_p"), F.sum("_neg").over(whole).alias("_n")
    ).where(F.col("_at") >= 0)
    tp, fp = F.col("tp"), F.col("fp")
    return swept.select(
        (F.lit(low) + F.col("_at") * (high - low) / steps).alias("threshold"),
        "tp",
        "fp",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("_p")).alias("recall"),
        ratio(fp, F.col("_n")).alias("false_alarm_rate"),
        ratio(2 * tp, tp + fp + F.col("_p")).alias("f1"),
    )


# ---- rule against classifier ------------------------------------------------------------------------


def best_threshold(swept: DataFrame, metric: str = "f1") -> float:
    """Threshold of a sweep with the highest metric, the lowest of equal ones; the sweep has a row per step."""
    return swept.orderBy(F.desc(metric), "threshold").first()["threshold"]


def threshold_at_recall(scored: DataFrame, recall: float, y: str = "y", score: str = "score") -> float | None:
    """Highest score limit that finds at least this share of the positives; null without positives."""
    return cumulative_rates(scored, y, score).where(F.col("tpr") >= recall).agg(F.max("score").alias("t")).first()["t"]


def rule_and_model(
    scored: DataFrame, col: str, limit: float, y: str = "y", score: str = "score", rule: str = "rule", model: str = "model"
) -> DataFrame:
    """Decisions of the rule ``col < limit`` and of the model at the rule's recall, on the same rows.

    The model's limit is the highest one whose recall is at least that of the rule. NaN is below no limit.
    """
    said = (F.col(col) < limit) & ~F.isnan(F.col(col).cast("double"))
    judged = scored.where(F.col(y).isin(0, 1) & F.col(col).isNotNull() & F.col(score).isNotNull()).withColumn(rule, said.cast("int"))
    recall = classification_metrics(judged, y, rule).first()["recall"]
    at = threshold_at_recall(judged, recall, y, score)
    return judged.withColumn(model, (F.col(score) >= F.lit(float("inf") if at is None else at)).cast("int"))


def paired_table(judged: DataFrame, y: str = "y", rule: str = "rule", model: str = "model") -> DataFrame:
    """Per class: rows that both get right, only the rule, only the model, and neither; one pass."""
    right = lambda c: F.col(c) == F.col(y)
    return judged.groupBy(F.col(y).cast("int").alias(y)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(right(rule) & right(model)).alias("both_right"),
        F.count_if(right(rule) & ~right(model)).alias("only_rule"),
        F.count_if(~right(rule) & right(model)).alias("only_model"),
        F.count_if(~right(rule) & ~right(model)).alias("neither"),
    )
