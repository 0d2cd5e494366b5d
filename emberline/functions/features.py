"""Derived columns of the detection table.

Every function adapts to the columns that exist: a derivation whose inputs are missing is left out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from emberline.schemas import MODEL_COLUMNS, TARGET

# Confidence words that mean "low", for both kinds of sensor.
LOW_CONFIDENCE = ("l", "low")


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def is_low_confidence(col: str = "confidence") -> Column:
    """Exact match after lower-casing, no trimming; null stays null."""
    return F.lower(F.col(col).cast("string")).isin(*LOW_CONFIDENCE)


def normalise_types(df: DataFrame) -> DataFrame:
    """``acq_time`` as whole number; text that is no number becomes null."""
    if not has(df, "acq_time"):
        return df
    return df.withColumn("acq_time", F.col("acq_time").try_cast("bigint"))


def parse_date(df: DataFrame, col: str = "acq_date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text dates become dates (null when they do not parse); timestamps lose the time of day."""
    if not has(df, col):
        return df
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.withColumn(col, F.try_to_date(F.col(col), fmt))
    return df.withColumn(col, F.col(col).cast("date"))


def with_delta_t(df: DataFrame) -> DataFrame:
    """Thermal contrast between the fire and the background channel."""
    if not has(df, "brightness", "bright_t31"):
        return df
    return df.withColumn("delta_t", F.col("brightness") - F.col("bright_t31"))


def with_month(df: DataFrame) -> DataFrame:
    if not has(df, "acq_date"):
        return df
    text = isinstance(df.schema["acq_date"].dataType, T.StringType)
    day = F.try_to_date(F.col("acq_date"), "yyyy-MM-dd") if text else F.col("acq_date")
    return df.withColumn("month", F.month(day).cast("tinyint"))


def with_hour(df: DataFrame) -> DataFrame:
    """Hour of an HHMM number, rounding down."""
    if not has(df, "acq_time"):
        return df
    return df.withColumn("hour", F.floor(F.col("acq_time") / 100).cast("bigint"))


def with_is_night(df: DataFrame) -> DataFrame:
    if not has(df, "daynight"):
        return df
    return df.withColumn("is_night", (F.col("daynight") == "N").cast("tinyint"))


def with_false_alarm_label(df: DataFrame) -> DataFrame:
    """Low confidence stands in for a false alarm; confidence itself is never a predictor."""
    if not has(df, "confidence"):
        return df
    return df.withColumn(TARGET, is_low_confidence().cast("tinyint"))


def feature_pass(df: DataFrame) -> DataFrame:
    """The three column-wise derivations in one pass over whatever columns exist."""
    return with_hour(with_month(with_delta_t(df)))


def model_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in MODEL_COLUMNS if c in df.columns])


def numeric_predictors(df: DataFrame, target: str = TARGET, exclude: Iterable[str] = ()) -> list[str]:
    skip = {target, *exclude}
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def to_float32(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Half the storage for model input; other columns stay as they are."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def grid_coordinate(col: str, decimals: int = 0) -> Column:
    """Rounded half away from zero; adding zero joins the cells at -0.0 and 0.0."""
    return F.round(F.col(col), decimals) + F.lit(0.0)


def with_grid_cell(df: DataFrame, decimals: int = 0) -> DataFrame:
    return df.withColumns(
        {
            "lat_bin": grid_coordinate("latitude", decimals),
            "lon_bin": grid_coordinate("longitude", decimals),
        }
    )


def class_label_text(col: str = TARGET) -> Column:
    # Readable names of the two classes.
    return (
        F.when(F.col(col) == 0, "0 = valid (nominal/high)")
        .when(F.col(col) == 1, "1 = probable false alarm (low)")
        .otherwise(F.col(col).cast("string"))
    )
