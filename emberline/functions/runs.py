"""Derived columns of run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def device_of(col: str = "backend") -> Column:
    """A backend is a GPU when its name says so; upper and lower case count."""
    name = F.coalesce(F.col(col).cast("string"), F.lit(""))
    # Name parts that mark a GPU backend.
    marked = name.contains("GPU") | name.contains("cuda") | name.contains("cuML")
    return F.when(marked, "GPU").otherwise("CPU")


def with_device(df: DataFrame) -> DataFrame:
    return df.withColumn("device", device_of())


def clean_model_name(df: DataFrame, col: str = "model") -> DataFrame:
    # Fixed value: suffix of rows that hold a time per epoch.
    return df.withColumn(col, F.regexp_replace(F.col(col), r"\s*\(por epoca\)", ""))


def throughput(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0))


def quotient(amount: Column, seconds: Column) -> Column:
    """Division as floating-point numbers have it: a time of zero gives infinity (NaN where the amount is zero, too)."""
    return F.when(seconds == 0, amount.cast("double") * F.lit(float("inf"))).otherwise(amount / seconds)


def with_throughput(df: DataFrame) -> DataFrame:
    """Rows and megabytes per second; the file size counts by the fraction of it that was read."""
    return df.withColumns(
        {
            "throughput_rows_s": throughput(F.col("rows"), F.col("time_s")),
            "throughput_mb_s": throughput(F.col("file_mb") * F.col("frac"), F.col("time_s")),
        }
    )


def parse_config(col: str = "config") -> Column:
    """Text such as ``{'max_depth': 4, 'eta': 0.3}`` as a map of numbers."""
    return F.from_json(F.replace(F.col(col), F.lit("'"), F.lit('"')), "map<string,double>")


def with_config_values(df: DataFrame, names: tuple[str, ...], col: str = "config") -> DataFrame:
    """One column per parameter; null where a configuration does not have it."""
    parsed = df.withColumn("_config", parse_config(col))
    return parsed.withColumns({n: F.try_element_at("_config", F.lit(n)) for n in names}).drop("_config")
