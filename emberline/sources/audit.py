"""Integrity of Parquet files and tables: one verdict per listed path.

Three steps, each where it belongs. A small reader looks at the ends of a file and at its footer, a few kilobytes
however large the file is. Spark's own reader then decodes every value of the files whose footer is sound, with
damaged files skipped instead of failing the job; it reads row groups of one file in several tasks. A file is whole
if as many rows were decoded as its footer names.

A path may be a folder: all data files below it are looked at, as many rows, bytes and row groups as they have
together are reported, and the folder has the status of its first file (by path) that is not ``ok``; a folder without
data files counts as missing. Paths in a store that only Spark's readers open are listed and read by them alone: rows
named by the footers against rows decoded. There a file without a readable footer is ``bad_footer`` whatever its ends
are, and row groups are not known.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberline.session import cut_lineage
from emberline.sources.run_files import path_exists

# Mark at both ends of a Parquet file, and the least size of one.
MARK = b"PAR1"
LEAST_BYTES = 12

VERDICT = "path string, status string, bytes bigint, rows bigint, columns int, row_groups int, has_background boolean"
ENDS = f"{VERDICT}, schema string, file string"
# Status of a path that only Spark's readers open; it never leaves this module.
SPARK_ONLY = "spark_only"


def _files(path: str) -> list[dict]:
    """What the ends and the footers of the file, or of all data files of the folder, say."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    row = dict(path=path, status="ok", bytes=None, rows=None, columns=None, row_groups=None, has_background=None, schema=None, file=path)
    remote = "://" in path or path.startswith("file:")
    try:
        fs, inner = pafs.FileSystem.from_uri(path) if remote else (pafs.LocalFileSystem(), path)
    except (OSError, pa.ArrowException):
        return [{**row, "status": SPARK_ONLY}]
    try:
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            return [{**row, "status": "missing"}]
        if info.type != pafs.FileType.Directory:
            return [_ends(fs, info, row)]
        below = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    except OSError:
        return [{**row, "status": "unreadable"}]
    # Names that begin with a dot or an underscore are not data, as for Spark's reader.
    shown = lambda p: not any(n[:1] in "._" and "=" not in n for n in p[len(inner) :].strip("/").split("/"))
    files = [f for f in below if f.type == pafs.FileType.File and shown(f.path)]
    full = lambda p: path.rstrip("/") + "/" + p[len(inner) :].strip("/")
    return [_ends(fs, f, {**row, "file": full(f.path)}) for f in files] or [{**row, "status": "missing"}]


def _ends(fs, info, row: dict) -> dict:
    """What the ends and the footer of one file say; ``schema`` is set where the footer is sound."""
    import pyarrow.parquet as pq

    try:
        inner, row = info.path, {**row, "bytes": info.size}
        if info.size < LEAST_BYTES:
            return {**row, "status": "too_small"}
        with fs.open_input_file(inner) as handle:
            head = handle.read(4)
            handle.seek(info.size - 4)
            if handle.read(4) != MARK:
                return {**row, "status": "truncated"}
            if head != MARK:
                return {**row, "status": "bad_header"}
            try:
                footer = pq.read_metadata(handle)
                names = footer.schema.to_arrow_schema()
            except Exception:
                return {**row, "status": "bad_footer"}
        return {
            **row, "rows": footer.num_rows, "columns": footer.num_columns, "row_groups": footer.num_row_groups,
            "has_background": "bright_t31" in names.names, "schema": names.remove_metadata().to_string(show_schema_metadata=False),
        }
    except OSError:
        return {**row, "status": "unreadable"}


def _check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in ENDS.split(", ")]
    for batch in batches:
        yield pd.DataFrame([row for p in batch["path"] for row in _files(p)], columns=columns)


def _plain(path: Column) -> Column:
    """A path as all readers write it."""
    return F.regexp_replace(path, "^file:/+", "/")


def decoded_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, n, digest): rows of files of one schema whose every value could be decoded, by a scan over all columns."""
    reader = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    rows = reader.parquet(*paths)
    # The hash needs every value; maps have none, their entries do.
    values = [F.map_entries(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in rows.schema]
    read = rows.select(_plain(F.col("_metadata.file_path")).alias("path"), F.xxhash64(*values).alias("h"))
    # Without the digest no value would have to be read for the count.
    return read.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("digest"))


def _plain_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, rows, n, columns, has_background) of a path that only Spark's readers open, by file."""
    rows = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(path)
    # A scan without columns takes its rows from the footers.
    named = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    decoded = decoded_rows(spark, [path]).select(F.col("path").alias("_path"), "n", "digest")
    found = named.join(decoded, _plain(F.col("file")) == F.col("_path"), "left")
    whole = F.when(F.col("digest").isNotNull(), F.col("n")).otherwise(0)
    return found.select(
        "file", "rows", whole.alias("n"), F.lit(len(rows.columns)).alias("columns"), F.lit("bright_t31" in rows.columns).alias("has_background")
    )


def _sound_footer(spark: SparkSession, file: str) -> bool:
    try:
        spark.read.parquet(file)
    except Exception:  # noqa: BLE001  whatever the store or the file says: there is no footer to be read
        return False
    return True


def _by_spark(spark: SparkSession, path: str) -> DataFrame:
    """Verdict for the files of one path that only Spark's readers open."""
    nothing = "cast(null as bigint) rows, cast(null as int) columns, cast(null as int) row_groups, cast(null as boolean) has_background"
    if not path_exists(spark, path):
        return spark.range(1).select(F.lit(path).alias("path"), F.lit(path).alias("file"), F.lit("missing").alias("status"),
                                     F.lit(None).cast("bigint").alias("bytes"), *[F.expr(e) for e in nothing.split(", ")])
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("_file"), "length")
    try:
        known = _plain_rows(spark, path)
    except AnalysisException:  # no file has a footer
        known = spark.createDataFrame([], "file string, rows bigint, n bigint, columns int, has_background boolean")
    rows = cut_lineage(listed.join(known, _plain(F.col("file")) == _plain(F.col("_file")), "left"))
    # Files without rows and files without a footer are not among those counted; there are few of them.
    silent = rows.where((F.col("length") >= LEAST_BYTES) & F.col("rows").isNull()).select("_file").collect()
    empty = [r["_file"] for r in silent if _sound_footer(spark, r["_file"])]
    no_rows = F.col("_file").isin(empty) if empty else F.lit(False)
    status = (
        F.when(F.col("length") < LEAST_BYTES, "too_small").when(no_rows, "ok").when(F.col("rows").isNull(), "bad_footer")
        .when(F.col("n") != F.col("rows"), "unreadable").otherwise("ok")
    )
    return rows.select(
        F.lit(path).alias("path"), F.col("_file").alias("file"), status.alias("status"), F.col("length").alias("bytes"),
        F.when(no_rows, 0).otherwise(F.col("rows")).alias("rows"), "columns", F.lit(None).cast("int").alias("row_groups"), "has_background",
    )


def _by_path(files: DataFrame) -> DataFrame:
    """One row per listed path; its status is that of its first file that is not whole."""
    bad = F.min(F.when(F.col("status") != "ok", F.struct("file", "status")))
    return files.groupBy("path").agg(
        F.coalesce(bad["status"], F.lit("ok")).alias("status"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.max("columns").alias("columns"), F.sum("row_groups").cast("int").alias("row_groups"),
        F.bool_and("has_background").alias("has_background"),
    )


def audit_files(files: DataFrame) -> DataFrame:
    """Verdict for every row of ``files`` (column ``path``)."""
    spark = files.sparkSession
    # Every path is looked at once, however often it is listed.
    seen = cut_lineage(files.select("path").distinct().repartition(spark.sparkContext.defaultParallelism).mapInPandas(_check, ENDS))
    # One scan per schema; Spark lists the files of a scan on the driver in any case.
    sound = seen.where("schema IS NOT NULL AND rows > 0").groupBy("schema").agg(F.collect_set("file").alias("files")).collect()
    scans = [decoded_rows(spark, list(r["files"])) for r in sound]
    counts = scans[0] if scans else spark.createDataFrame([], "path string, n bigint, digest bigint")
    for other in scans[1:]:
        counts = counts.unionByName(other)
    found = seen.join(counts.withColumnRenamed("path", "_path"), _plain(F.col("file")) == F.col("_path"), "left")
    decoded = F.when(F.col("digest").isNotNull(), F.col("n")).otherwise(0)
    broken = F.col("schema").isNotNull() & (decoded != F.col("rows"))
    names = [part.split()[0] for part in VERDICT.split(", ")]
    judged = found.withColumn("status", F.when(broken, "unreadable").otherwise(F.col("status"))).select(*names, "file")
    verdicts = judged.where(F.col("status") != SPARK_ONLY)
    for row in seen.where(F.col("status") == SPARK_ONLY).select("path").collect():
        verdicts = verdicts.unionByName(_by_spark(spark, row["path"]))
    listed = files.select(F.col("path").alias("_listed"))
    one = _by_path(verdicts)
    return listed.join(one, F.col("_listed").eqNullSafe(F.col("path"))).select(*names)


def audit_parquet(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Verdict for listed paths, spread over the cluster; a path that does not exist is reported."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return audit_files(listed)


def audit_folder(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Verdict for all files below a folder; the listing itself is a distributed source."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path")
    )
    return audit_files(listing)
