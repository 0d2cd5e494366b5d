"""The profiling report over raw detections: a name and a lazy query per section."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberline.operators import profile

# Columns of the correlation section.
CORRELATED = ("brightness", "bright_t31", "frp", "latitude", "longitude", "scan", "track")


def eda_report(detections: DataFrame) -> dict[str, DataFrame]:
    columns = [c for c in CORRELATED if c in detections.columns]
    return {
        "rows": profile.row_count(detections),
        "dates": profile.date_range(detections),
        "daily": profile.daily_series(detections),
        "peak_days": profile.peak_days(detections),
        "monthly": profile.monthly_counts(detections),
        "hourly": profile.hourly_counts(detections),
        "cells": profile.grid_density(detections),
        "top_cells": profile.top_cells(detections),
        "satellites": profile.by_satellite(detections),
        "confidence": profile.confidence_distribution(detections),
        "frp": profile.frp_stats(detections),
        "frp_histogram": profile.histogram(detections, "frp"),
        "frp_histogram_clipped": profile.histogram(detections, "frp", clip_q=0.99),
        "contrast": profile.contrast_by_confidence(detections),
        "correlations": profile.correlation_matrix(detections, columns),
    }
