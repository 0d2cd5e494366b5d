"""Row filters on detections and run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from emberline.functions.features import has, is_low_confidence


def drop_low_confidence(df: DataFrame, null_policy: str = "drop") -> DataFrame:
    """Rows that are not of low confidence; ``null_policy="keep"`` also keeps unknown confidence.

    Without a confidence column, rows with positive radiative power are taken instead.
    """
    if not has(df, "confidence"):
        return positive_frp(df)
    low = is_low_confidence()
    if null_policy == "keep":
        low = F.coalesce(low, F.lit(False))
    elif null_policy != "drop":
        raise ValueError(f"unknown null policy: {null_policy}")
    return df.where(~low)


def drop_exact_confidence(df: DataFrame, value: str = "low") -> DataFrame:
    """Early form of the filter: one word, case counts."""
    return df.where(F.col("confidence").cast("string") != value)


def positive_frp(df: DataFrame) -> DataFrame:
    return df.where(F.col("frp") > 0)


def valid_frp() -> Column:
    return F.col("frp") >= 0


def valid_latitude() -> Column:
    return F.col("latitude").between(-90, 90)


def valid_longitude() -> Column:
    return F.col("longitude").between(-180, 180)


def clean_detections(df: DataFrame) -> DataFrame:
    """Physically possible rows. NaN power passes, as NaN sorts above every number."""
    return df.where(valid_frp() & valid_latitude() & valid_longitude())


def quality_breakdown(df: DataFrame) -> DataFrame:
    """Rows that fail each rule of ``clean_detections``, in one pass. Null fails a rule."""

    def fails(rule: Column) -> Column:
        return ~F.coalesce(rule, F.lit(False))

    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(fails(valid_frp())).alias("bad_frp"),
        F.count_if(F.isnan("frp")).alias("nan_frp"),
        F.count_if(fails(valid_latitude())).alias("bad_latitude"),
        F.count_if(fails(valid_longitude())).alias("bad_longitude"),
        F.count_if(fails(valid_frp() & valid_latitude() & valid_longitude())).alias("removed"),
    )


def runs_of(df: DataFrame, regime: str | None = None, backends: Sequence[str] | None = None) -> DataFrame:
    if regime is not None:
        df = df.where(F.col("regime") == regime)
    if backends is not None:
        df = df.where(F.col("backend").isin(*backends))
    return df
