"""Run tables and metric documents on disk."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberline.schemas import BENCH_RUNS, STORED_NAMES, STORED_VALUES


def append_runs(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Add rows to a run table; every CSV part file carries the header."""
    writer = df.write.mode("append")
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    writer.format(fmt).save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked through the reader, which knows every file system the cluster does."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def english_names(df: DataFrame) -> DataFrame:
    """Stored headers and words become the names used by the operators; others stay."""
    df = df.withColumnsRenamed({k: v for k, v in STORED_NAMES.items() if k in df.columns})
    words = F.create_map(*[F.lit(x) for pair in STORED_VALUES.items() for x in pair])
    for c in ("regime", "operation"):
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.try_element_at(words, F.col(c)), F.col(c)))
    return df


def read_runs(spark: SparkSession, path: str, schema: T.StructType = BENCH_RUNS) -> DataFrame:
    """A CSV run table by header name; an empty table when the path does not exist.

    Columns the file lacks are null, columns the schema does not name are left out. Whole numbers may be
    written with a decimal point. Files of one table must agree in their header. What does not parse becomes
    null; :func:`unparsed_values` counts it.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    text = runs_as_text(spark, path)
    return text.select(
        *[parsed(F.col(f.name), f.dataType).alias(f.name) if f.name in text.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    )


def runs_as_text(spark: SparkSession, path: str) -> DataFrame:
    return english_names(spark.read.option("header", True).option("enforceSchema", False).csv(path))


def parsed(text: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    number = text.try_cast("decimal(38,6)")
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def unparsed_values(spark: SparkSession, path: str, schema: T.StructType = BENCH_RUNS) -> DataFrame:
    """(column, n): per column of the schema that the files have, values that are text but not of its type."""
    text = runs_as_text(spark, path)
    counts = [
        F.struct(F.lit(f.name).alias("column"), F.count_if(F.col(f.name).isNotNull() & parsed(F.col(f.name), f.dataType).isNull()).alias("n"))
        for f in schema
        if f.name in text.columns
    ]
    return text.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def write_metrics_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, lines: bool = True
) -> DataFrame:
    """JSON documents, one per line, or with ``lines=False`` one per file; empty when there is no such path."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    reader = spark.read.option("multiLine", not lines)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_best_configs(spark: SparkSession, path: str) -> DataFrame:
    """A document ``{model: config text}`` as rows (model, config)."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json(F.col("value"), "map<string,string>")
    return text.select(F.explode(pairs).alias("model", "config"))
