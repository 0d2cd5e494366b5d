"""What the physical plans must and must not hold."""

import re

from emberline.operators import evaluation, filters, profile, sampling
from emberline.operators.ranking import exact_quantiles, with_rank
from emberline.plans.benchmark import OPERATIONS, run_operation
from emberline.plans.model_table import model_table
from emberline.registry import views
from emberline.schemas import REQUIRED_COLUMNS
from emberline.sources.tables import scan_detections, select_required, write_table


def plan(df, final=False):
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def executed(text):
    """The plan without the parts that describe what was planned before it ran."""
    kept, skip = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def stored(spark, small, tmp_path):
    path = str(tmp_path / "det")
    write_table(views.detections(spark, small), path)
    return scan_detections(spark, path)


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)))


def test_aggregate_reads_three_columns_and_merges_before_the_shuffle(spark, small, tmp_path):
    text = plan(OPERATIONS["aggregate"](stored(spark, small, tmp_path)))
    assert read_columns(text) == {"frp", "acq_date", "satellite"}
    assert text.count("Exchange") == 1 and "partial_avg" in text and "partial_count" in text


def test_cleaning_reaches_the_scan(spark, small, tmp_path):
    text = plan(model_table(stored(spark, small, tmp_path)))
    assert "GreaterThanOrEqual(frp,0.0)" in text and "LessThanOrEqual(latitude,90.0)" in text
    assert "Exchange" not in text
    assert not read_columns(text) & {"version", "instrument"}


def test_features_and_filter_do_not_shuffle(spark, small, tmp_path):
    df = stored(spark, small, tmp_path)
    for name in ("features", "filter", "load"):
        text = plan(OPERATIONS[name](df))
        assert "Exchange" not in text and "Python" not in text
    assert read_columns(plan(select_required(df))) == set(REQUIRED_COLUMNS)
    assert run_operation(df, "load") > 0


def test_shares_need_no_window(spark, small):
    text = plan(profile.confidence_distribution(views.detections(spark, small)))
    assert "Window" not in text


def test_top_k_is_taken_per_task_first(spark, small):
    assert "TakeOrderedAndProject" in plan(profile.top_cells(views.detections(spark, small)))


def test_quantiles_scan_once(spark, small):
    """The sketch, the range sums and the rows share one scan and one shuffle by value."""
    df = views.detections(spark, small)
    q = exact_quantiles(df, "frp", {"p": 0.95})
    q.collect()
    final = executed(q._jdf.queryExecution().executedPlan().toString())
    assert final.count("FileScan") == 1


def single_task_windows(text):
    """Windows over a single partition whose rows were not merged by range or cell before."""
    found = []
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = " ".join(lines[max(0, i - 4) : i])
            below = " ".join(lines[i : i + 6])
            if "Window" in above and not re.search(r"keys?=\[_(range|cell|groupingexpression)#\d+", below):
                found.append(line)
    return found


def test_no_raw_rows_in_a_single_task_window(spark, small):
    preds = views.predictions(spark, small)
    frames = [
        exact_quantiles(preds, "score", {"p": 0.5}),
        with_rank(views.table(spark, small, "events").select("event_id"), "event_id"),
        evaluation.roc_auc(preds),
        evaluation.roc_points(preds),
        sampling.exact_fraction(views.table(spark, small, "events"), 0.2, ["event_id"]),
    ]
    for frame in frames:
        text = frame._jdf.queryExecution().sparkPlan().toString() + plan(frame)
        assert not single_task_windows(text)


def test_hash_split_is_a_projection(spark, small):
    text = plan(sampling.stratified_split(views.labelled(spark, small), views.ROW_KEY))
    assert "Exchange" not in text and "Python" not in text


def test_breakdown_is_one_pass(spark, small):
    text = plan(filters.quality_breakdown(views.detections(spark, small)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
