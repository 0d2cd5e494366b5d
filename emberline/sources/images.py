"""Image folders ``<split>/<label>/<file>``: one row per image, contents not read.

Folder names may carry a key, as in ``split=train``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def image_manifest(spark: SparkSession, root: str, pattern: str = "*.{jpg,jpeg,png}") -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    parts = F.transform(F.split("path", "/"), lambda p: F.regexp_replace(p, "^[^=]*=", ""))
    return files.select(
        "path",
        F.element_at(parts, -3).alias("split"),
        F.element_at(parts, -2).alias("label"),
        "length",
    )


def manifest_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
