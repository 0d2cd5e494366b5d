"""Windowed CSV drops: planning, resuming and reading them, and cutting out an area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberline.functions.features import normalise_types
from emberline.schemas import DETECTIONS

# Fixed value: longest window a drop may cover.
MAX_DAYS = 10

# Named boxes, (west, south, east, north); None is the whole world.
AREAS = {
    "mundo": None,
    "world": None,
    "canada": (-141.0, 41.7, -52.6, 83.1),
    "costa-rica": (-86.0, 8.0, -82.5, 11.3),
    "norteamerica": (-170.0, 14.0, -50.0, 84.0),
}


def plan_windows(bounds: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """Windows of at most ``max_days`` for each inclusive range (``start``, ``end``) in ``bounds``."""
    first = F.sequence("start", "end", F.expr(f"interval {int(max_days)} days"))
    return bounds.select(F.explode(first).alias("window_start"), "end").select(
        "window_start",
        F.least(F.lit(int(max_days)), F.datediff("end", "window_start") + 1).alias("days"),
    )


def drop_name(start: Column, days: Column) -> Column:
    # Fixed value: file name pattern of a drop.
    return F.format_string("firms_%s_%02dd.csv", F.date_format(start, "yyyy-MM-dd"), days)


def landed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows whose file exists and is not empty; contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "firms_*d.csv")
        .load(folder)
        .where(F.col("length") > 0)
        .select(F.regexp_extract("path", r"firms_(\d{4}-\d{2}-\d{2})_(\d+)d\.csv$", 0).alias("name"))
    )
    return listing.select(
        F.try_to_date(F.substring("name", 7, 10), "yyyy-MM-dd").alias("window_start"),
        F.regexp_extract("name", r"_(\d+)d\.csv$", 1).try_cast("int").alias("days"),
    )


def pending_windows(planned: DataFrame, landed: DataFrame) -> DataFrame:
    return planned.join(landed.select("window_start", "days"), ["window_start", "days"], "left_anti")


CORRUPT = "corrupt_record"


def drop_schema(schema: T.StructType, corrupt: str | None = CORRUPT) -> T.StructType:
    """The schema drops are read with: times as text, and a column for lines that do not fit."""
    fields = [T.StructField(f.name, T.StringType()) if f.name == "acq_time" else f for f in schema]
    return T.StructType([*fields, *([T.StructField(corrupt, T.StringType())] if corrupt else [])])


def csv_options(corrupt: str | None = CORRUPT) -> dict:
    kept = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    return {"header": True, "enforceSchema": False, "dateFormat": "yyyy-MM-dd", "pathGlobFilter": "*.csv", **kept}


def ingest_csv(
    spark: SparkSession, folder: str, schema: T.StructType = DETECTIONS, corrupt: str | None = CORRUPT
) -> DataFrame:
    """All CSV files of a folder as one table. Empty files add nothing.

    A line with a value that does not parse, or with too few or too many fields, stays as a row: what did
    parse is there, and the column ``corrupt`` holds the whole line (null for sound rows).

    ``acq_time`` is read as text first, so that a bad value gives null. The header of every file is
    checked against the schema, so that a file with other columns fails instead of being misread.
    """
    return normalise_types(spark.read.schema(drop_schema(schema, corrupt)).options(**csv_options(corrupt)).csv(folder))


def area_box(area: str) -> tuple[float, float, float, float] | None:
    if area in AREAS:
        return AREAS[area]
    west, south, east, north = (float(part) for part in area.split(","))
    return west, south, east, north


def filter_area(df: DataFrame, area: str) -> DataFrame:
    """Rows inside a named box or ``west,south,east,north`` (limits included)."""
    box = area_box(area)
    if box is None:
        return df
    west, south, east, north = box
    return df.where(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))


# ---- schema of a drop ---------------------------------------------------------------------------------

# What a value can be, as bits: of several values the bits are put together. Lowest first.
KINDS = (
    ("whole", r"^[+-]?\d{1,18}$"),
    ("number", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
    ("date", r"^\d{4}-\d{2}-\d{2}$"),
)
#: Lines of a file that its types are taken from.
FIRST_LINES = 10_000


def kind_of(value: Column) -> Column:
    """The bit of the narrowest kind of a text value: whole number, number, date, or text; 0 for null and empty."""
    text = F.trim(value)
    out = F.when(value.isNull() | (text == ""), 0)
    for k, (name, pattern) in enumerate(KINDS):
        fits = text.rlike(pattern) if name != "date" else text.rlike(pattern) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
        out = out.when(fits, 1 << k)
    return out.otherwise(1 << len(KINDS))


def joined_type(bits: int) -> T.DataType:
    """The least type that holds all kinds that were seen; a column of nulls is text."""
    if bits == 1:
        return T.LongType()
    if bits in (2, 3):
        return T.DoubleType()
    return T.DateType() if bits == 4 else T.StringType()


def infer_schema(spark: SparkSession, folder: str, lines: int = FIRST_LINES) -> T.StructType:
    """Column types of a folder of CSV files from the first lines of every file, merged over the files.

    Every value is one of four kinds; a column's type is the least one above all its kinds (whole number below
    number, all below text). Only the first block of a file is looked at. The driver gets one row of bits.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    names = reader.csv(folder).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    values = [F.col(f"`{c}`").alias(f"v{k}") for k, c in enumerate(names)]
    read = reader.schema(text).csv(folder).select(
        *values,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ).where("_block = 0")
    # Lines of a block lie in one task, one behind another: one row per file says where its lines begin.
    begins = read.groupBy("_file").agg(F.min("_line").alias("_first"))
    first = read.join(begins, "_file").where(F.col("_line") < F.col("_first") + lines)
    seen = first.agg(*[F.bit_or(kind_of(F.col(f"v{k}"))).alias(f"v{k}") for k in range(len(names))]).first()
    return T.StructType([T.StructField(c, joined_type(seen[k] or 0)) for k, c in enumerate(names)])
