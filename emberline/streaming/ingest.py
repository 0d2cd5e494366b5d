"""Incremental ingest of CSV drops into a Parquet table."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from emberline.functions.features import normalise_types
from emberline.schemas import DETECTIONS
from emberline.sources.drops import csv_options, drop_schema


def ingest_stream(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = DETECTIONS,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every file that is new since the last run, once, then stop.

    Files already taken are kept in the checkpoint, so a run that was cut off resumes where it
    stopped, and the file sink publishes each batch as a whole. Lines that do not fit the schema are kept
    as by :func:`emberline.sources.drops.ingest_csv`.
    """
    reader = spark.readStream.schema(drop_schema(schema)).options(**csv_options())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = normalise_types(reader.csv(folder)).withColumn("ingested_from", F.col("_metadata.file_name"))
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
