"""Parquet tables: scan, column selection, file order, writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from emberline.schemas import REQUIRED_COLUMNS, TARGET

def scan_detections(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan; counting it reads footers only."""
    return spark.read.parquet(path)


def select_required(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    return df.select(*[c for c in required if c in df.columns])


def with_file_position(spark: SparkSession, path: str, out: str = "position") -> DataFrame:
    """Rows with their zero-based position in file order (files by path, rows as stored).

    A single file needs nothing but the row index of the reader. For several files the rows of the
    files before are added. The table of file offsets has 16 bytes per file of the listing that the
    driver holds anyway (13 MB for the 800,000 files of 100 TB), so it is broadcast; files are told
    apart by a hash of their path, and paths whose hashes collide are an error.
    """
    rows = spark.read.parquet(path)
    located = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )
    files = rows.inputFiles()
    if len(files) <= 1:
        return located.withColumnRenamed("_index", out).drop("_file")
    sizes = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row per file of the listing that the driver already holds.
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.xxhash64("_file").alias("_key"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    single = offsets.groupBy("_key").agg(F.max("_offset").alias("_offset"), F.count(F.lit(1)).alias("_files")).select(
        "_key",
        F.when(F.col("_files") == 1, F.col("_offset")).otherwise(F.raise_error(F.lit("two file paths have one hash"))).alias("_offset"),
    )
    placed = located.withColumn("_key", F.xxhash64("_file")).join(F.broadcast(single), "_key")
    return placed.select(*rows.columns, (F.col("_offset") + F.col("_index")).alias(out))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, so that a later read of one split touches only its files."""
    df.write.mode("overwrite").option("compression", "snappy").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def split_rates(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Size and share of positives of every split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), (100 * F.avg(F.col(target).cast("double"))).alias("pct_positive")
    )
