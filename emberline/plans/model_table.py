"""From raw detections to the table the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberline.functions.features import (
    model_columns,
    normalise_types,
    parse_date,
    with_delta_t,
    with_false_alarm_label,
    with_hour,
    with_is_night,
    with_month,
)
from emberline.operators.filters import clean_detections
from emberline.operators.profile import class_balance
from emberline.sources.tables import scan_detections, write_table


def labelled_detections(detections: DataFrame) -> DataFrame:
    """Clean rows with all derived columns and the target; other columns stay."""
    typed = parse_date(normalise_types(detections))
    derived = with_is_night(with_hour(with_month(with_delta_t(typed))))
    return clean_detections(with_false_alarm_label(derived))


def model_table(detections: DataFrame) -> DataFrame:
    return model_columns(labelled_detections(detections))


def build_model_table(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Write the model table and return the class balance read back from it."""
    write_table(model_table(scan_detections(spark, source)), out)
    return class_balance(scan_detections(spark, out))
