"""Queries over detections: derived columns, filters, profile, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.functions import features
from emberline.functions.hashing import below, hash32
from emberline.operators import filters, profile, sampling
from emberline.operators.evaluation import positive_weight
from emberline.operators.ranking import exact_quantiles, with_rank
from emberline.plans.benchmark import OPERATIONS
from emberline.plans.model_table import model_table
from emberline.registry.book import register
from emberline.registry.views import DETECTIONS, ROW_KEY, VALID, detections, hash_sql, labelled, sql_with, table
from emberline.schemas import PREDICTORS, REQUIRED_COLUMNS
from emberline.sources.tables import scan_detections, select_required, with_file_position


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def typed(df: DataFrame, kind: str, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c in cols})


def on_detections(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(detections(spark, sf_dir))


def on_labelled(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(labelled(spark, sf_dir))


# ---- scans and projections ------------------------------------------------------------------

register(
    "satellite_month",
    "A12 P2",
    on_detections(lambda d: rounded(typed(profile.satellite_month(select_required(d)), "int", "month"), 6, "mean_frp")),
    sql_with(
        "det",
        "SELECT satellite, CAST(month(acq_date) AS INTEGER) AS month, count(*) AS n, round(avg(frp), 6) AS mean_frp "
        "FROM det GROUP BY ALL",
    ),
)
register(
    "scan_detections",
    "S1 A1",
    lambda spark, sf_dir: profile.row_count(scan_detections(spark, f"{sf_dir}/lineitem.parquet")),
    "SELECT count(*) AS n FROM lineitem",
)
register(
    "select_required",
    "S2",
    on_detections(select_required),
    sql_with("det", f"SELECT {', '.join(REQUIRED_COLUMNS)} FROM det"),
)
register(
    "normalise_types",
    "S4",
    on_detections(
        lambda d: features.normalise_types(
            d.select(
                "acq_date",
                F.expr("case when acq_time % 50 = 7 then 'abc' else lpad(cast(acq_time as string), 4, '0') end").alias(
                    "acq_time"
                ),
            )
        )
    ),
    sql_with("det", "SELECT acq_date, CASE WHEN acq_time % 50 = 7 THEN NULL ELSE acq_time END AS acq_time FROM det"),
)
register(
    "with_delta_t",
    "P1",
    on_detections(lambda d: features.with_delta_t(d).select("brightness", "bright_t31", "delta_t")),
    sql_with("det", "SELECT brightness, bright_t31, brightness - bright_t31 AS delta_t FROM det"),
)
register(
    "with_month",
    "P2",
    on_detections(lambda d: typed(features.with_month(d).select("acq_date", "month"), "int", "month")),
    sql_with("det", "SELECT acq_date, CAST(month(acq_date) AS INTEGER) AS month FROM det"),
)
register(
    "with_hour",
    "P3",
    on_detections(lambda d: features.with_hour(d).select("acq_time", "hour")),
    sql_with("det", "SELECT acq_time, acq_time // 100 AS hour FROM det"),
)
register(
    "with_is_night",
    "P4",
    on_detections(lambda d: typed(features.with_is_night(d).select("daynight", "is_night"), "int", "is_night")),
    sql_with("det", "SELECT daynight, CASE WHEN daynight = 'N' THEN 1 ELSE 0 END AS is_night FROM det"),
)
register(
    "with_false_alarm_label",
    "P5",
    on_detections(
        lambda d: typed(
            features.with_false_alarm_label(d).select("confidence", "is_false_alarm"), "int", "is_false_alarm"
        )
    ),
    sql_with(
        "det",
        "SELECT confidence, CASE WHEN confidence IN ('l', 'LOW', 'low', 'L') THEN 1 ELSE 0 END AS is_false_alarm FROM det",
    ),
)
register(
    "model_table",
    "P6 F4",
    on_detections(lambda d: typed(model_table(d), "int", "month", "is_night", "is_false_alarm")),
    sql_with(
        "lab",
        "SELECT delta_t, brightness, bright_t31, frp, scan, track, CAST(month AS INTEGER) AS month, hour, "
        "CAST(is_night AS INTEGER) AS is_night, latitude, longitude, CAST(is_false_alarm AS INTEGER) AS is_false_alarm FROM lab",
    ),
)
register(
    "numeric_predictors",
    "P7",
    on_labelled(
        lambda d: features.model_columns(d).select(*features.numeric_predictors(features.model_columns(d))).agg(
            *[F.round(F.avg(c), 6).alias(c) for c in PREDICTORS]
        )
    ),
    sql_with("lab", f"SELECT {', '.join(f'round(avg({c}), 6) AS {c}' for c in PREDICTORS)} FROM lab"),
)
register(
    "to_float32",
    "P8",
    on_labelled(lambda d: typed(features.to_float32(d.select(*PREDICTORS), PREDICTORS), "double", *PREDICTORS)),
    sql_with("lab", f"SELECT {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in PREDICTORS)} FROM lab"),
)
register(
    "parse_date",
    "P9",
    on_detections(
        lambda d: features.parse_date(
            d.select(
                "acq_time",
                F.expr("case when acq_time % 37 = 5 then 'n/a' else cast(acq_date as string) end").alias("acq_date"),
            )
        )
    ),
    sql_with("det", "SELECT acq_time, CASE WHEN acq_time % 37 = 5 THEN NULL ELSE acq_date END AS acq_date FROM det"),
)
register(
    "with_grid_cell",
    "P10",
    on_detections(lambda d: features.with_grid_cell(d.select("latitude", "longitude"))),
    sql_with(
        "det",
        "SELECT latitude, longitude, round(latitude) + 0.0 AS lat_bin, round(longitude) + 0.0 AS lon_bin FROM det",
    ),
)
register(
    "feature_pass",
    "P11",
    on_detections(lambda d: typed(OPERATIONS["features"](d).select("delta_t", "month", "hour"), "int", "month")),
    sql_with(
        "det",
        "SELECT brightness - bright_t31 AS delta_t, CAST(month(acq_date) AS INTEGER) AS month, acq_time // 100 AS hour FROM det",
    ),
)
register(
    "class_label_text",
    "P16",
    on_labelled(lambda d: d.select(features.class_label_text().alias("class")).groupBy("class").agg(profile.rows_counted())),
    sql_with(
        "lab",
        "SELECT CASE is_false_alarm WHEN 0 THEN '0 = valid (nominal/high)' WHEN 1 THEN '1 = probable false alarm (low)' END "
        "AS class, count(*) AS n FROM lab GROUP BY 1",
    ),
)
register(
    "clip_upper",
    "P17",
    on_detections(lambda d: rounded(profile.clip_upper(d.select("frp")), 6, "frp")),
    sql_with("det", "SELECT round(least(frp, (SELECT quantile_cont(frp, 0.99) FROM det)), 6) AS frp FROM det"),
)

# ---- filters ----------------------------------------------------------------------------------

register(
    "drop_low_confidence",
    "F1",
    on_detections(OPERATIONS["filter"]),
    sql_with("det", f"SELECT {', '.join(REQUIRED_COLUMNS)} FROM det WHERE lower(confidence) NOT IN ('l', 'low')"),
)
register(
    "drop_exact_confidence",
    "F2",
    on_detections(lambda d: filters.drop_exact_confidence(d, "LOW").select("acq_date", "confidence", "frp")),
    sql_with("det", "SELECT acq_date, confidence, frp FROM det WHERE confidence <> 'LOW'"),
)
register(
    "positive_frp",
    "F3",
    on_detections(lambda d: filters.drop_low_confidence(d.select("acq_date", "frp"))),
    sql_with("det", "SELECT acq_date, frp FROM det WHERE frp > 0"),
)
register(
    "clean_detections",
    "F4",
    on_detections(lambda d: filters.clean_detections(d).select("acq_date", "frp", "latitude", "longitude")),
    sql_with("det", f"SELECT acq_date, frp, latitude, longitude FROM det WHERE {VALID}"),
)
register(
    "quality_breakdown",
    "F5",
    on_detections(filters.quality_breakdown),
    sql_with(
        "det",
        "SELECT count(*) AS total, count(*) FILTER (NOT frp >= 0) AS bad_frp, count(*) FILTER (isnan(frp)) AS nan_frp, "
        "count(*) FILTER (latitude NOT BETWEEN -90 AND 90) AS bad_latitude, "
        "count(*) FILTER (longitude NOT BETWEEN -180 AND 180) AS bad_longitude, "
        f"count(*) FILTER (NOT ({VALID})) AS removed FROM det",
    ),
)

# ---- profile ----------------------------------------------------------------------------------

register("row_count", "A1", on_detections(profile.row_count), sql_with("det", "SELECT count(*) AS n FROM det"))
register(
    "date_range",
    "A2",
    on_detections(profile.date_range),
    sql_with("det", "SELECT min(acq_date) AS first_date, max(acq_date) AS last_date FROM det"),
)
TYPES = {
    "latitude": "double",
    "longitude": "double",
    "brightness": "double",
    "bright_t31": "double",
    "frp": "double",
    "acq_date": "date",
    "acq_time": "bigint",
    "satellite": "string",
    "confidence": "string",
    "daynight": "string",
}


def with_gaps(d: DataFrame) -> DataFrame:
    """Nulls where the power is negative, so that there is something to count."""
    return select_required(d).withColumn("frp", F.expr("case when frp >= 0 then frp end"))


GAPS = "SELECT * REPLACE (CASE WHEN frp >= 0 THEN frp END AS frp) FROM det"

register(
    "null_profile",
    "A3",
    on_detections(lambda d: rounded(profile.null_profile(with_gaps(d)), 6, "pct_nulls")),
    sql_with(
        "det",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) FILTER ({c} IS NULL) AS nulls, "
            f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6) AS pct_nulls FROM gaps"
            for c, t in TYPES.items()
        ),
        gaps=GAPS,
    ),
)
register(
    "dataset_profile",
    "A34",
    on_detections(lambda d: profile.dataset_profile(with_gaps(d))),
    sql_with(
        "det",
        " UNION ALL ".join(
            f"SELECT count(*) AS rows, {len(TYPES)} AS columns, min(acq_date) AS first_date, max(acq_date) AS last_date, "
            f"'{c}' AS \"column\", '{t}' AS type, count(*) FILTER ({c} IS NULL) AS nulls FROM gaps"
            for c, t in TYPES.items()
        ),
        gaps=GAPS,
    ),
)
register(
    "daily_series",
    "A4",
    on_detections(profile.daily_series),
    sql_with("det", "SELECT acq_date, count(*) AS n FROM det GROUP BY acq_date"),
)
register(
    "monthly_counts",
    "A5",
    on_detections(lambda d: typed(profile.monthly_counts(d), "int", "month")),
    sql_with("det", "SELECT CAST(month(acq_date) AS INTEGER) AS month, count(*) AS n FROM det GROUP BY 1"),
)
register(
    "hourly_counts",
    "A6",
    on_detections(profile.hourly_counts),
    sql_with("det", "SELECT acq_time // 100 AS hour, count(*) AS n FROM det GROUP BY 1"),
)
CELLS = "SELECT round(latitude) + 0.0 AS lat_bin, round(longitude) + 0.0 AS lon_bin, count(*) AS n FROM det GROUP BY ALL"
register("grid_density", "A7", on_detections(profile.grid_density), sql_with("det", CELLS))
register(
    "by_satellite",
    "A8",
    on_detections(profile.by_satellite),
    sql_with("det", "SELECT satellite, count(*) AS n FROM det GROUP BY satellite"),
)
register(
    "confidence_distribution",
    "A9 W2",
    on_detections(lambda d: rounded(profile.confidence_distribution(d), 6, "pct")),
    sql_with(
        "det",
        "SELECT confidence, n, round(100.0 * n / sum(n) OVER (), 6) AS pct "
        "FROM (SELECT confidence, count(*) AS n FROM det GROUP BY confidence)",
    ),
)
STATS = ("mean", "median", "std", "p95", "max")
register(
    "frp_stats",
    "A10",
    on_detections(lambda d: rounded(profile.frp_stats(d), 6, *STATS)),
    sql_with(
        "det",
        "SELECT round(avg(frp), 6) AS mean, round(median(frp), 6) AS median, round(stddev_samp(frp), 6) AS std, "
        "round(quantile_cont(frp, 0.95), 6) AS p95, round(max(frp), 6) AS max FROM det",
    ),
)
register(
    "frp_stats_discrete",
    "A10",
    on_detections(lambda d: rounded(profile.frp_stats(d, "discrete"), 6, *STATS)),
    sql_with(
        "det",
        "SELECT round(avg(frp), 6) AS mean, round(median(frp), 6) AS median, round(stddev_samp(frp), 6) AS std, "
        "round(quantile_disc(frp, 0.95), 6) AS p95, round(max(frp), 6) AS max FROM det",
    ),
)
register(
    "frp_quantiles_by_satellite",
    "A10",
    on_detections(
        lambda d: rounded(exact_quantiles(d, "frp", {"p50": 0.5, "p95": 0.95}, by=["satellite"]), 6, "p50", "p95")
    ),
    sql_with(
        "det",
        "SELECT satellite, round(quantile_cont(frp, 0.5), 6) AS p50, round(quantile_cont(frp, 0.95), 6) AS p95 "
        "FROM det GROUP BY satellite",
    ),
)
register(
    "contrast_by_confidence",
    "A11",
    on_detections(lambda d: rounded(profile.contrast_by_confidence(d), 6, "mean_delta_t", "mean_frp")),
    sql_with(
        "det",
        "SELECT confidence, round(avg(brightness - bright_t31), 6) AS mean_delta_t, round(avg(frp), 6) AS mean_frp, "
        "count(*) AS n FROM det GROUP BY confidence",
    ),
)
register(
    "class_balance",
    "A13 W2",
    on_labelled(lambda d: rounded(typed(profile.class_balance(d), "int", "is_false_alarm"), 6, "pct")),
    sql_with(
        "lab",
        "SELECT CAST(is_false_alarm AS INTEGER) AS is_false_alarm, n, round(100.0 * n / sum(n) OVER (), 6) AS pct "
        "FROM (SELECT is_false_alarm, count(*) AS n FROM lab GROUP BY is_false_alarm)",
    ),
)


def _corr_sql(cols: tuple[str, ...]) -> str:
    one = [f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM lab" for a in cols for b in cols if a != b]
    one += [f"SELECT '{c}' AS a, '{c}' AS b, 1.0::DOUBLE AS r FROM lab HAVING count(*) > 0" for c in cols]
    return " UNION ALL ".join(one)


register(
    "correlation_matrix",
    "A14",
    on_labelled(lambda d: rounded(profile.correlation_matrix(features.model_columns(d)), 9, "r")),
    sql_with("lab", _corr_sql(PREDICTORS)),
)


def _histogram_sql(values: str, bins: int) -> str:
    return sql_with(
        "det",
        f"SELECT CAST(b AS INTEGER) AS bin, round(low + (high - low) * (b - 1) / {bins}, 6) AS bin_low, "
        f"round(low + (high - low) * b / {bins}, 6) AS bin_high, coalesce(n, 0) AS n FROM lim "
        f"CROSS JOIN generate_series(1, {bins}) AS s(b) LEFT JOIN cnt ON cnt.bin = b",
        val=values,
        lim="SELECT min(v) AS low, max(v) AS high FROM val",
        cnt=f"SELECT least(floor((v - low) * {bins} / (high - low)) + 1, {bins}) AS bin, count(*) AS n "
        "FROM val CROSS JOIN lim GROUP BY 1",
    )


register(
    "histogram",
    "A15",
    on_detections(lambda d: rounded(profile.histogram(d, "frp"), 6, "bin_low", "bin_high")),
    _histogram_sql("SELECT frp AS v FROM det", 80),
)
register(
    "histogram_clipped",
    "A15 P17",
    on_detections(lambda d: rounded(profile.histogram(d, "frp", clip_q=0.99), 6, "bin_low", "bin_high")),
    _histogram_sql("SELECT least(frp, (SELECT quantile_cont(frp, 0.99) FROM det)) AS v FROM det", 80),
)
register(
    "positive_weight",
    "A25",
    on_labelled(lambda d: rounded(positive_weight(d, "is_false_alarm"), 9, "positive_weight")),
    sql_with(
        "lab",
        "SELECT round(count(*) FILTER (is_false_alarm = 0) / greatest(count(*) FILTER (is_false_alarm = 1), 1), 9) "
        "AS positive_weight FROM lab",
    ),
)
register(
    "peak_days",
    "O1",
    on_detections(profile.peak_days),
    sql_with("det", "SELECT acq_date, count(*) AS n FROM det GROUP BY acq_date ORDER BY n DESC, acq_date LIMIT 3"),
)
register(
    "top_cells",
    "O2",
    on_detections(profile.top_cells),
    sql_with("det", f"{CELLS} ORDER BY n DESC, lat_bin, lon_bin LIMIT 5"),
)

# ---- row order, samples, splits -----------------------------------------------------------------

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")


def events_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_file_position(spark, f"{sf_dir}/events.parquet").select(*EVENT_COLUMNS, "position")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENT_COLUMNS)


EVENTS = ", ".join(EVENT_COLUMNS)
NUMBERED = f"SELECT {EVENTS}, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events"

register(
    "rank_by_key",
    "O4 M1",
    lambda spark, sf_dir: with_rank(events(spark, sf_dir), "event_id").select("event_id", "position"),
    f"SELECT event_id, position FROM ({NUMBERED})",
)
register(
    "prefix_fraction",
    "O4",
    lambda spark, sf_dir: sampling.prefix_fraction(events_in_file_order(spark, sf_dir), 0.3).select(*EVENT_COLUMNS),
    f"SELECT {EVENTS} FROM ({NUMBERED}) WHERE position < floor((SELECT count(*) FROM events) * 0.3::DOUBLE)",
)
register(
    "prefix_fraction_by_key",
    "O4",
    lambda spark, sf_dir: sampling.prefix_fraction(with_rank(events(spark, sf_dir), "event_id"), 0.6).select(
        *EVENT_COLUMNS
    ),
    f"SELECT {EVENTS} FROM ({NUMBERED}) WHERE position < floor((SELECT count(*) FROM events) * 0.6::DOUBLE)",
)
register(
    "every_kth",
    "M1",
    lambda spark, sf_dir: sampling.every_kth(
        events_in_file_order(spark, sf_dir), sampling.step_of_fraction(0.03)
    ).select(*EVENT_COLUMNS),
    f"SELECT {EVENTS} FROM ({NUMBERED}) WHERE position % 33 = 0",
)
register(
    "systematic_sample",
    "M1",
    lambda spark, sf_dir: sampling.systematic_sample(events_in_file_order(spark, sf_dir), 700).select(*EVENT_COLUMNS),
    f"SELECT {EVENTS} FROM ({NUMBERED}) WHERE position % greatest(1, (SELECT count(*) FROM events) // 700) = 0",
)
register(
    "bernoulli",
    "M2",
    lambda spark, sf_dir: sampling.bernoulli(events(spark, sf_dir), 0.3, keys=["event_id"]),
    f"SELECT {EVENTS} FROM events WHERE {hash_sql('event_id')} < {int(0.3 * 2**32)}",
)
register(
    "exact_fraction",
    "M3",
    lambda spark, sf_dir: sampling.exact_fraction(events(spark, sf_dir), 0.15, ["event_id"]),
    f"SELECT {EVENTS} FROM (SELECT {EVENTS}, row_number() OVER (ORDER BY {hash_sql('event_id')}, event_id) AS r FROM events) "
    "WHERE r <= floor((SELECT count(*) FROM events) * 0.15::DOUBLE)",
)
register(
    "stratified_split",
    "M4",
    on_labelled(
        lambda d: sampling.stratified_split(d, ROW_KEY)
        .groupBy("split", F.col("is_false_alarm").cast("int").alias("is_false_alarm"))
        .agg(profile.rows_counted())
    ),
    sql_with(
        "lab",
        f"SELECT CASE WHEN h < {int(0.70 * 2**32)} THEN 'train' WHEN h < {int(0.85 * 2**32)} THEN 'val' ELSE 'test' END AS split, "
        f"CAST(is_false_alarm AS INTEGER) AS is_false_alarm, count(*) AS n "
        f"FROM (SELECT *, {hash_sql(*ROW_KEY)} AS h FROM lab) GROUP BY ALL",
    ),
)
SIZES = {
    "sizes": "SELECT is_false_alarm AS c, count(*) AS n, sum(count(*)) OVER () AS a FROM lab GROUP BY 1",
    "held": "SELECT *, (a * 30 + 99) // 100 AS rest, n * ((a * 30 + 99) // 100) // a AS low, "
    "n * ((a * 30 + 99) // 100) % a AS over FROM sizes",
    "held2": "SELECT *, low + CASE WHEN row_number() OVER (ORDER BY over DESC, c) <= rest - sum(low) OVER () THEN 1 ELSE 0 END "
    "AS held FROM held",
    "tested": "SELECT *, held * ((rest + 1) // 2) // rest AS low2, held * ((rest + 1) // 2) % rest AS over2 FROM held2",
    "parts": "SELECT c, n, n - held AS n_train, low2 + CASE WHEN row_number() OVER (ORDER BY over2 DESC, c) <= "
    "(rest + 1) // 2 - sum(low2) OVER () THEN 1 ELSE 0 END AS n_test FROM tested",
}
register(
    "exact_stratified_split",
    "M4",
    on_labelled(
        lambda d: sampling.exact_stratified_split(d, ROW_KEY).select(
            *ROW_KEY, F.col("is_false_alarm").cast("int").alias("is_false_alarm"), "split"
        )
    ),
    sql_with(
        "lab",
        f"SELECT {', '.join(ROW_KEY)}, CAST(is_false_alarm AS INTEGER) AS is_false_alarm, "
        "CASE WHEN r <= n_train THEN 'train' WHEN r <= n - n_test THEN 'val' ELSE 'test' END AS split "
        "FROM numbered JOIN parts ON is_false_alarm = c",
        **SIZES,
        numbered=f"SELECT *, row_number() OVER (PARTITION BY is_false_alarm ORDER BY {hash_sql(*ROW_KEY)}, "
        f"{', '.join(ROW_KEY)}) AS r FROM lab",
    ),
)


def map_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_file_position(spark, f"{sf_dir}/lineitem.parquet")
    placed = lines.selectExpr(
        f"{DETECTIONS['latitude']} AS latitude", f"{DETECTIONS['longitude']} AS longitude", "position"
    )
    return sampling.map_sample(placed, 5_000)


register(
    "map_sample",
    "M5",
    map_sample,
    sql_with(
        "raw",
        "SELECT latitude, longitude FROM placed WHERE position % greatest(1, (SELECT count(*) FROM placed) // 5000) = 0",
        placed="SELECT latitude, longitude, row_number() OVER () - 1 AS position FROM raw",
    ),
)


def sample_agrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each satellite in a one-third hash sample: a check that no group is favoured."""
    rows = labelled(spark, sf_dir).where(below(hash32(ROW_KEY), 1 / 3))
    return rows.groupBy("satellite").agg(profile.rows_counted())


register(
    "bernoulli_by_satellite",
    "M2",
    sample_agrees,
    sql_with("lab", f"SELECT satellite, count(*) AS n FROM lab WHERE {hash_sql(*ROW_KEY)} < {int(1 / 3 * 2**32)} GROUP BY satellite"),
)
