"""The shapes of the engine's tables, derived row by row from the given tables.

The expressions mean the same in Spark SQL and in the checking engine, so each is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions.runs import clean_model_name, quotient, with_throughput
from emberline.plans.model_table import labelled_detections
from emberline.sources.tables import scan_detections

# Columns that identify a detection.
ROW_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "acq_date")

DETECTIONS = {
    "l_orderkey": "l_orderkey",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_linenumber": "l_linenumber",
    "latitude": "cast((l_partkey * 37 + l_orderkey * 11) % 18400 as double) / 100.0 - 92.0",
    "longitude": "cast((l_suppkey * 7919 + l_orderkey * 13) % 36000 as double) / 100.0 - 180.0",
    "brightness": "295.0 + l_quantity",
    "bright_t31": "cast(270 + l_partkey % 40 as double)",
    "frp": "case when l_orderkey % 97 = 0 then -l_extendedprice / 2000.0 else l_extendedprice / 2000.0 end",
    "scan": "cast(32 + l_suppkey % 48 as double) / 100.0",
    "track": "cast(36 + l_partkey % 42 as double) / 100.0",
    "acq_date": "cast(l_shipdate as date)",
    "acq_time": "cast((l_orderkey % 24) * 100 + l_partkey % 60 as bigint)",
    "satellite": "case l_linenumber % 3 when 0 then 'N20' when 1 then 'SNPP' else 'N21' end",
    "instrument": "'VIIRS'",
    "version": "'2.0NRT'",
    "daynight": "case when l_linestatus = 'F' then 'D' else 'N' end",
    "u": "(l_orderkey * 31 + l_partkey * 17 + l_suppkey * 13 + l_linenumber * 7) % 100",
}

CUT = (
    "case when brightness - bright_t31 < 15 and abs(frp) < 20 then 60 "
    "when brightness - bright_t31 < 15 then 5 when abs(frp) < 5 then 25 else 2 end"
)

CONFIDENCE = (
    f"case when u < ({CUT}) then case when l_linenumber % 2 = 0 then 'l' else 'LOW' end "
    "when u >= 94 then 'h' else 'n' end"
)

BENCH_RUNS = {
    "backend": "case event_type when 'click' then 'pandas' when 'view' then 'polars' "
    "when 'purchase' then 'dask' else 'cudf' end",
    "operation": "case event_id % 4 when 0 then 'load' when 1 then 'filter' when 2 then 'aggregate' else 'features' end",
    "threads": "case when event_type = 'click' then 1 else case user_id % 5 when 0 then 1 when 1 then 2 "
    "when 2 then 4 when 3 then 8 else 16 end end",
    "regime": "case when event_id % 5 = 0 then 'weak' else 'strong' end",
    "frac": "case when event_id % 3 = 0 then cast(0.5 as double) else cast(1.0 as double) end",
    "repetition": "cast(event_id as int)",
    "time_s": "value",
    "rows": "1000 + event_id",
    "peak_mem_mb": "cast(100 + user_id as double)",
    "file_mb": "cast(100 + user_id % 7 as double)",
}

DEVICE_RUNS = {
    "run_id": "event_id",
    "dataset_pct": "case event_id % 3 when 0 then '30%' when 1 then '60%' else '100%' end",
    "train_rows": "case event_id % 3 when 0 then 300000 when 1 then 600000 else 1000000 end + user_id",
    "test_rows": "60000 + user_id",
    "model": "case user_id % 3 when 0 then 'Random Forest' when 1 then 'Boosted Trees' "
    "else 'Neural Network (por epoca)' end",
    "backend": "case event_type when 'click' then 'CPU' when 'purchase' then 'CPU (sklearn)' "
    "when 'view' then 'GPU (cuML)' when 'signup' then 'cuda' else 'GPU (cuda)' end",
    "time_s": "value",
    "f1": "cast(event_id % 1000 as double) / 1000.0",
    "ram_peak_mb": "cast(1000 + user_id as double) + value",
    "gpu_mem_peak_mb": "cast(event_id % 500 as double)",
    "gpu_util_avg_pct": "cast(event_id % 101 as double)",
}

SHARES = {
    "accuracy": "cast(sum(case when value < 50 then 1 else 0 end) as double) / count(*)",
    "precision": "cast(sum(case when event_type = 'click' then 1 else 0 end) as double) / count(*)",
    "recall": "cast(sum(case when event_type = 'view' then 1 else 0 end) as double) / count(*)",
    "f1": "cast(2 * sum(case when event_type in ('click', 'view') and value < 20 then 1 else 0 end) as double)"
    " / (count(*) + sum(case when event_type in ('click', 'view') then 1 else 0 end))",
    "roc_auc": "cast(sum(case when event_id % 2 = 0 then 1 else 0 end) as double) / count(*)",
}

QUOTE = "chr(39)"

SEARCH_RUNS = {
    "model": "case user_id % 3 when 0 then 'Random Forest' when 1 then 'Boosted Trees' else 'Neural Network' end",
    "config": "case user_id % 3 "
    f"when 0 then concat('{{', {QUOTE}, 'n_estimators', {QUOTE}, ': ', 100 * (1 + event_id % 3), ', ', "
    f"{QUOTE}, 'max_depth', {QUOTE}, ': ', 8 * (1 + event_id % 2), '}}') "
    f"when 1 then concat('{{', {QUOTE}, 'max_depth', {QUOTE}, ': ', 4 * (1 + event_id % 3), ', ', "
    f"{QUOTE}, 'eta', {QUOTE}, ': 0.', 1 + event_id % 3, '}}') "
    f"else concat('{{', {QUOTE}, 'batch_size', {QUOTE}, ': ', 2048 * (1 + event_id % 4), ', ', "
    f"{QUOTE}, 'lr', {QUOTE}, ': 0.00', 1 + event_id % 5, '}}') end",
    "f1": "cast((user_id * 37 + event_id * 11) % 1000 as double) / 1000.0",
    "time_s": "value",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_detections(spark, f"{sf_dir}/{name}.parquet")


def keyed_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with the columns that identify a row."""
    return detections_of(table(spark, sf_dir, "lineitem"))


def detections_of(lineitem: DataFrame) -> DataFrame:
    raw = lineitem.selectExpr(*[f"{expr} AS {name}" for name, expr in DETECTIONS.items()])
    return raw.withColumn("confidence", F.expr(CONFIDENCE)).drop("u")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [c for c in ROW_KEY if c != "acq_date"]
    return keyed_detections(spark, sf_dir).drop(*keys)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean detections with key, derived columns and target."""
    return labelled_detections(keyed_detections(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, two scores (one with many ties, one with few) and a threshold decision."""
    rows = labelled(spark, sf_dir)
    return rows.select(
        F.col("is_false_alarm").cast("int").alias("y"),
        (-F.col("delta_t")).alias("score"),
        (-F.col("frp")).alias("fine_score"),
        "delta_t",
        (F.col("delta_t") < 15).cast("int").alias("pred"),
    )


def _events(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def bench_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_throughput(_events(spark, sf_dir, BENCH_RUNS))


def device_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = clean_model_name(_events(spark, sf_dir, DEVICE_RUNS))
    return runs.withColumn("throughput_rows_s", quotient(F.col("train_rows"), F.col("time_s")))


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = [F.expr(expr).alias(name) for name, expr in SHARES.items()]
    times = [F.max("value").alias("train_time_s"), F.min("value").alias("infer_time_s")]
    grouped = table(spark, sf_dir, "events").groupBy(F.expr("concat('model-', user_id)").alias("model"))
    return grouped.agg(*shares, *times)


def image_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = [F.expr(expr).alias(name) for name, expr in SHARES.items()]
    return table(spark, sf_dir, "events").groupBy(F.expr("concat('image-', event_type)").alias("model")).agg(*shares)


def search_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, SEARCH_RUNS)


# ---- the same shapes as named subqueries of the checking SQL ------------------------------------

LOW = "lower(confidence) IN ('l', 'low')"
VALID = "frp >= 0 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"

SUBQUERIES = {
    "raw": f"SELECT {_select(DETECTIONS)} FROM lineitem",
    "det": f"SELECT * EXCLUDE (u), {CONFIDENCE} AS confidence FROM raw",
    "lab": "SELECT *, brightness - bright_t31 AS delta_t, CAST(month(acq_date) AS TINYINT) AS month, "
    "CAST(floor(acq_time / 100.0) AS BIGINT) AS hour, CAST(daynight = 'N' AS TINYINT) AS is_night, "
    f"CAST({LOW} AS TINYINT) AS is_false_alarm FROM det WHERE {VALID}",
    "pred": "SELECT CAST(is_false_alarm AS INTEGER) AS y, -delta_t AS score, -frp AS fine_score, delta_t, "
    "CAST(delta_t < 15 AS INTEGER) AS pred FROM lab",
    "runs": f"SELECT *, rows / time_s AS throughput_rows_s, file_mb * frac / time_s AS throughput_mb_s "
    f"FROM (SELECT {_select(BENCH_RUNS)} FROM events)",
    "summ": "SELECT backend, operation, threads, regime, frac, median(time_s) AS time_s, min(time_s) AS min_time_s, "
    "max(time_s) AS max_time_s, median(CAST(rows AS DOUBLE)) AS rows, "
    "median(throughput_rows_s) AS throughput_rows_s, median(throughput_mb_s) AS throughput_mb_s, "
    "max(peak_mem_mb) AS peak_mem_mb, count(*) AS n_runs FROM runs GROUP BY ALL",
    "base": "SELECT operation, first(time_s ORDER BY threads, frac) FILTER (backend = 'pandas') AS main, "
    "first(time_s ORDER BY frac) FILTER (backend = 'polars' AND threads = 1) AS other "
    "FROM summ WHERE regime = 'strong' GROUP BY operation",
    "single": "SELECT operation, backend, first(time_s ORDER BY frac) AS single "
    "FROM summ WHERE regime = 'strong' AND threads = 1 GROUP BY operation, backend",
    "rep": "SELECT s.*, CASE WHEN regime = 'strong' THEN coalesce(main, other) / time_s END AS global_speedup, "
    "CASE WHEN main IS NOT NULL THEN 'pandas-1thread' WHEN other IS NOT NULL THEN 'polars-1thread' ELSE '' END "
    "AS baseline_used, CASE WHEN regime = 'strong' THEN single / time_s END AS parallel_speedup, "
    "CASE WHEN regime = 'strong' AND s.backend <> 'pandas' THEN single / time_s / threads END AS efficiency "
    "FROM summ s LEFT JOIN base b ON s.operation = b.operation "
    "LEFT JOIN single p ON s.operation = p.operation AND s.backend = p.backend",
    "dev": "SELECT * REPLACE (regexp_replace(model, '\\s*\\(por epoca\\)', '', 'g') AS model), "
    "train_rows / time_s AS throughput_rows_s, "
    "CASE WHEN contains(backend, 'GPU') OR contains(backend, 'cuda') OR contains(backend, 'cuML') "
    f"THEN 'GPU' ELSE 'CPU' END AS device FROM (SELECT {_select(DEVICE_RUNS)} FROM events)",
    "spd": "SELECT model, dataset_pct, c / g AS speedup FROM (SELECT model, dataset_pct, "
    "first(time_s ORDER BY run_id) FILTER (device = 'CPU') AS c, "
    "first(time_s ORDER BY run_id) FILTER (device = 'GPU') AS g FROM dev GROUP BY ALL) "
    "WHERE c IS NOT NULL AND g IS NOT NULL",
    "scal": "SELECT d.model, d.device, dataset_pct, (time_s / base_time) / (train_rows / base_rows) AS scaling_index "
    "FROM dev d JOIN (SELECT model, device, first(time_s ORDER BY run_id) AS base_time FROM dev "
    "WHERE dataset_pct = '30%' GROUP BY ALL) t ON d.model = t.model AND d.device = t.device "
    "CROSS JOIN (SELECT first(train_rows ORDER BY run_id) AS base_rows FROM dev WHERE dataset_pct = '30%') "
    "WHERE dataset_pct <> '30%'",
    "met": f"SELECT concat('model-', user_id) AS model, {_select(SHARES)}, max(value) AS train_time_s, "
    "min(value) AS infer_time_s FROM events GROUP BY user_id",
    "img": f"SELECT concat('image-', event_type) AS model, {_select(SHARES)} FROM events GROUP BY event_type",
    "sea": f"SELECT {_select(SEARCH_RUNS)} FROM events",
}

NEEDS = {
    "raw": [],
    "det": ["raw"],
    "lab": ["det"],
    "pred": ["lab"],
    "runs": [],
    "summ": ["runs"],
    "base": ["summ"],
    "single": ["summ"],
    "rep": ["summ", "base", "single"],
    "dev": [],
    "spd": ["dev"],
    "scal": ["dev"],
    "met": [],
    "img": [],
    "sea": [],
}


def sql_with(names: str, query: str, **more: str) -> str:
    """The query preceded by the named subqueries (with what they need) and its own ``more``."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} AS ({SUBQUERIES[n]})" for n in order]
    parts += [f"{n} AS ({text})" for n, text in more.items()]
    return f"WITH {', '.join(parts)} {query}"


def hash_sql(*keys: str, seed: int = 42) -> str:
    text = ", ".join([*(f"CAST({k} AS VARCHAR)" for k in keys), f"'{seed}'"])
    return f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT)"
