"""Queries that write the given tables to the shared folder and read them back, and file checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions.hashing import below, hash32
from emberline.operators.profile import class_balance, rows_counted
from emberline.operators.sampling import stratified_split
from emberline.plans.model_table import build_model_table
from emberline.registry import views
from emberline.registry.book import register
from emberline.registry.detection_queries import rounded, typed
from emberline.registry.views import ROW_KEY, hash_sql, sql_with
from emberline.schemas import DETECTIONS, MODEL_METRICS, TARGET
from emberline.session import scratch_path
from emberline.sources import audit, contract, drops, images, run_files, tables
from emberline.streaming.ingest import ingest_stream

RAW_COLUMNS = [f.name for f in DETECTIONS]


def csv_drop(spark: SparkSession, sf_dir: str) -> str:
    """Detections as a folder of CSV files, with some unreadable times and some unreadable brightness values."""
    folder = scratch_path(spark, "drop")
    bad = F.when(F.col("acq_time") % 50 == 7, F.lit("abc")).otherwise(F.lpad(F.col("acq_time").cast("string"), 4, "0"))
    broken = F.when(F.col("acq_time") % 50 == 9, F.lit("12,5x")).otherwise(F.col("brightness").cast("string"))
    rows = views.detections(spark, sf_dir).select(*RAW_COLUMNS).withColumns({"acq_time": bad, "brightness": broken})
    rows.write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(folder)
    return folder


def by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("acq_date").agg(
        rows_counted(),
        F.count_if(F.col("acq_time").isNull()).alias("n_bad_time"),
        F.sum("acq_time").alias("sum_time"),
        F.round(F.sum("frp"), 6).alias("sum_frp"),
        F.count_if(F.col(drops.CORRUPT).isNotNull()).alias("n_corrupt"),
        F.round(F.sum("brightness"), 6).alias("sum_brightness"),
    )


BY_DAY = (
    "SELECT acq_date, count(*) AS n, count(*) FILTER (acq_time % 50 = 7) AS n_bad_time, "
    "CAST(sum(acq_time) FILTER (acq_time % 50 <> 7) AS BIGINT) AS sum_time, round(sum(frp), 6) AS sum_frp, "
    "count(*) FILTER (acq_time % 50 = 9) AS n_corrupt, round(sum(brightness) FILTER (acq_time % 50 <> 9), 6) AS sum_brightness "
    "FROM det GROUP BY acq_date"
)

register(
    "ingest_csv",
    "S3 S4",
    lambda spark, sf_dir: by_day(drops.ingest_csv(spark, csv_drop(spark, sf_dir))),
    sql_with("det", BY_DAY),
)


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "streamed")
    query = ingest_stream(spark, csv_drop(spark, sf_dir), out, scratch_path(spark, "streamed-log"))
    query.awaitTermination()
    return by_day(spark.read.parquet(out))


register("ingest_stream", "S12", streamed, sql_with("det", BY_DAY))


def written_model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch_path(spark, "raw")
    tables.write_table(views.detections(spark, sf_dir), raw)
    balance = build_model_table(spark, raw, scratch_path(spark, "model-table"))
    return rounded(typed(balance, "int", TARGET), 6, "pct")


register(
    "write_table",
    "S5 P6",
    written_model_table,
    sql_with(
        "lab",
        "SELECT CAST(is_false_alarm AS INTEGER) AS is_false_alarm, n, round(100.0 * n / sum(n) OVER (), 6) AS pct "
        "FROM (SELECT is_false_alarm, count(*) AS n FROM lab GROUP BY is_false_alarm)",
    ),
)


def written_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    tables.write_splits(stratified_split(views.labelled(spark, sf_dir), ROW_KEY), path)
    return rounded(tables.split_rates(spark.read.parquet(path)), 6, "pct_positive")


register(
    "write_splits",
    "S6",
    written_splits,
    sql_with(
        "lab",
        f"SELECT CASE WHEN h < {int(0.70 * 2**32)} THEN 'train' WHEN h < {int(0.85 * 2**32)} THEN 'val' ELSE 'test' END AS split, "
        "count(*) AS n, round(100 * avg(is_false_alarm), 6) AS pct_positive "
        f"FROM (SELECT *, {hash_sql(*ROW_KEY)} AS h FROM lab) GROUP BY 1",
    ),
)

RUN_COLUMNS = ("backend", "operation", "threads", "regime", "frac", "repetition", "time_s", "rows", "peak_mem_mb", "file_mb")


def appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    runs = views.bench_runs(spark, sf_dir)
    for regime in ("strong", "weak"):
        run_files.append_runs(runs.where(F.col("regime") == regime), path)
    return run_files.read_runs(spark, path).select(*RUN_COLUMNS)


register(
    "append_runs",
    "S7 S8",
    appended_runs,
    sql_with("runs", f"SELECT {', '.join(RUN_COLUMNS)} FROM runs"),
)


def stored_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    run_files.write_metrics_json(views.model_metrics(spark, sf_dir), path)
    return run_files.read_metrics_json(spark, path, MODEL_METRICS).select("model", "accuracy", "f1", "roc_auc", "train_time_s")


register(
    "metrics_json",
    "S9",
    stored_metrics,
    sql_with("met", "SELECT model, accuracy, f1, roc_auc, train_time_s FROM met"),
)

# ---- windows ------------------------------------------------------------------------------------


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = views.detections(spark, sf_dir).agg(F.min("acq_date").alias("start"), F.max("acq_date").alias("end"))
    return drops.plan_windows(dates)


WINDOWS = (
    "SELECT CAST(s AS DATE) AS window_start, CAST(least(10, last - CAST(s AS DATE) + 1) AS INTEGER) AS days "
    "FROM (SELECT min(acq_date) AS first, max(acq_date) AS last FROM det), generate_series(first, last, INTERVAL 10 DAY) AS g(s)"
)
register("plan_windows", "S10", planned, sql_with("det", WINDOWS))


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows without a day of more than 40 detections, such days standing for landed files."""
    windows = planned(spark, sf_dir)
    busy = views.detections(spark, sf_dir).groupBy("acq_date").agg(rows_counted()).where("n > 40")
    first = views.detections(spark, sf_dir).agg(F.min("acq_date").alias("first")).scalar()
    start = F.date_add("first", (F.floor(F.datediff("acq_date", "first") / 10) * 10).cast("int"))
    starts = busy.withColumn("first", first).select(start.alias("window_start")).distinct()
    landed = starts.join(windows, "window_start").select("window_start", "days")
    return drops.pending_windows(windows, landed)


register(
    "pending_windows",
    "S11 J6",
    pending,
    sql_with(
        "det",
        "SELECT window_start, days FROM win WHERE NOT EXISTS (SELECT 1 FROM (SELECT acq_date FROM det GROUP BY acq_date "
        "HAVING count(*) > 40) WHERE acq_date >= window_start AND acq_date < window_start + days)",
        win=WINDOWS,
    ),
)
for _area, _box in (("canada", (-141.0, 41.7, -52.6, 83.1)), ("-86,8,-82.5,11.3", (-86.0, 8.0, -82.5, 11.3))):
    register(
        "filter_area" if _area == "canada" else "filter_area_box",
        "S13",
        lambda spark, sf_dir, a=_area: drops.filter_area(views.detections(spark, sf_dir), a).select(
            "latitude", "longitude", "acq_date"
        ),
        sql_with(
            "det",
            f"SELECT latitude, longitude, acq_date FROM det WHERE longitude BETWEEN {_box[0]} AND {_box[2]} "
            f"AND latitude BETWEEN {_box[1]} AND {_box[3]}",
        ),
    )

# ---- audits and contracts -------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = audit.audit_parquet(spark, [f"{sf_dir}/{t}.parquet" for t in [*TABLES, "absent"]])
    return verdicts.select(F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table"), "status", "rows")


register(
    "audit_parquet",
    "S14",
    audited,
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", 'ok' AS status, count(*) AS rows FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'absent', 'missing', NULL",
)


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.detections(spark, sf_dir).drop("version", "scan").withColumn("extra", F.lit(1))
    found = found.withColumn("acq_time", F.col("acq_time").cast("int"))
    return contract.contract_report(found, DETECTIONS)


OUTSIDE = {
    "latitude": "latitude NOT BETWEEN -90 AND 90",
    "longitude": "longitude NOT BETWEEN -180 AND 180",
    "frp": "frp < 0",
    "acq_time": "acq_time NOT BETWEEN 0 AND 2359 OR acq_time % 100 > 59",
    "confidence": "lower(confidence) NOT IN ('l', 'n', 'h', 'low', 'nominal', 'high')",
    "daynight": "daynight NOT IN ('D', 'N')",
}


def _contract_sql() -> str:
    rows = []
    for name, kind in [*((f.name, f.dataType.simpleString()) for f in DETECTIONS), ("extra", None)]:
        gone = name in ("version", "scan")
        status = "missing" if gone else "extra" if kind is None else "other_type" if name == "acq_time" else "ok"
        actual = None if gone else "int" if kind is None or name == "acq_time" else kind
        count = f"count(*) FILTER ({OUTSIDE[name]})" if name in OUTSIDE else "CAST(NULL AS BIGINT)"
        text = lambda v: "NULL" if v is None else f"'{v}'"
        rows.append(
            f"SELECT '{name}' AS \"column\", '{status}' AS status, {name in ('brightness', 'bright_t31')} AS critical, "
            f"{text(kind)} AS expected_type, {text(actual)} AS actual_type, {count} AS outside_domain FROM det"
            + ("" if name in OUTSIDE else " HAVING count(*) > 0")
        )
    return sql_with("det", " UNION ALL ".join(rows))


register("contract_report", "S15 U1", contract_rows, _contract_sql())


def balance_by_satellite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class balance by satellite of a table written in one folder per satellite."""
    path = scratch_path(spark, "by-satellite")
    views.labelled(spark, sf_dir).write.partitionBy("satellite").parquet(path)
    return rounded(typed(class_balance(spark.read.parquet(path), by="satellite"), "int", TARGET), 6, "pct")


register(
    "partitioned_table",
    "S5 A13",
    balance_by_satellite,
    sql_with(
        "lab",
        "SELECT satellite, CAST(is_false_alarm AS INTEGER) AS is_false_alarm, n, "
        "round(100.0 * n / sum(n) OVER (PARTITION BY satellite), 6) AS pct FROM "
        "(SELECT satellite, is_false_alarm, count(*) AS n FROM lab GROUP BY ALL)",
    ),
)


# ---- schema of a drop, image folders -------------------------------------------------------------------


def inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a CSV drop by its first lines, and what the contract says of the table read with them."""
    folder = scratch_path(spark, "clean-drop")
    rows = views.detections(spark, sf_dir).select(*RAW_COLUMNS)
    rows.write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(folder)
    schema = drops.infer_schema(spark, folder)
    read = spark.read.schema(schema).options(**drops.csv_options(None)).csv(folder)
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column string, type string")
    counts = read.agg(*[F.count(c).alias(c) for c in schema.names]).unpivot([], schema.names, "column", "n_values")
    return types.join(counts, "column")


INFERRED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v FROM (SELECT {', '.join(RAW_COLUMNS)} FROM det)" for c in RAW_COLUMNS
)
register(
    "infer_schema",
    "S3",
    inferred,
    sql_with(
        "det",
        'SELECT "column", CASE WHEN bool_and(regexp_full_match(v, \'[+-]?[0-9]{1,18}\')) THEN \'bigint\' '
        "WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) THEN 'double' WHEN bool_and(TRY_CAST(v AS DATE) IS NOT NULL) THEN 'date' "
        'ELSE \'string\' END AS type, count(v) AS n_values FROM long WHERE v IS NOT NULL GROUP BY "column"',
        long=INFERRED,
    ),
)


# Files that a task writes.
TASK_FILES = 512
# On a local disk Hadoop makes a second file with checksums for each and starts a process for every mode it sets (four a
# file); without checksums it is one. Other file systems are as they were.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": True}


def image_folder(spark: SparkSession, sf_dir: str) -> str:
    """Stored vectors as a folder of small files ``split=<part>/label=<class>/<file>``, one for each.

    A table may be one file that one task reads, so its rows are dealt to tasks first.
    """
    folder = scratch_path(spark, "images")
    part = F.when(below(hash32(["vec_id"]), 0.80), "train").otherwise("valid")
    rows = views.table(spark, sf_dir, "embeddings").select(
        F.concat_ws(" ", F.transform("embedding", lambda x: x.cast("string"))).alias("value"), part.alias("split"), "label"
    )
    dealt = rows.repartition(max(1, -(-rows.count() // TASK_FILES)))
    dealt.write.options(maxRecordsPerFile=1, **SMALL_FILES).partitionBy("split", "label").text(folder)
    return folder


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = images.image_manifest(spark, image_folder(spark, sf_dir), "*.txt")
    return images.manifest_counts(files.where(F.col("length") > 0)).select("split", F.col("label").cast("int").alias("label"), "n")


register(
    "image_manifest",
    "S16",
    manifest,
    f"SELECT CASE WHEN {hash_sql('vec_id')} < {int(0.80 * 2**32)} THEN 'train' ELSE 'valid' END AS split, "
    "CAST(label AS INTEGER) AS label, count(*) AS n FROM embeddings GROUP BY ALL",
)
