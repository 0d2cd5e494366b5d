"""The four preprocessing operations that are timed, and a timer for them."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from emberline.functions.features import feature_pass
from emberline.operators.filters import drop_low_confidence
from emberline.operators.profile import satellite_month
from emberline.sources.tables import select_required

OPERATIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "load": select_required,
    "filter": lambda df: drop_low_confidence(select_required(df)),
    "aggregate": lambda df: satellite_month(select_required(df)),
    "features": lambda df: feature_pass(select_required(df)),
}


def run_operation(df: DataFrame, operation: str) -> float:
    """Seconds to compute every row and column of an operation's result, without storing it."""
    start = time.perf_counter()
    OPERATIONS[operation](df).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start
