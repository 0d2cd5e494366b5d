"""Column lists and schemas of the tables the operators read and write."""

from pyspark.sql import types as T

# Raw detections, one row per hotspot.
DETECTIONS = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("brightness", T.DoubleType()),
        T.StructField("scan", T.DoubleType()),
        T.StructField("track", T.DoubleType()),
        T.StructField("acq_date", T.DateType()),
        T.StructField("acq_time", T.LongType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("bright_t31", T.DoubleType()),
        T.StructField("frp", T.DoubleType()),
        T.StructField("daynight", T.StringType()),
    ]
)

# The columns the four preprocessing operations need.
REQUIRED_COLUMNS = (
    "latitude",
    "longitude",
    "brightness",
    "bright_t31",
    "frp",
    "acq_date",
    "acq_time",
    "satellite",
    "confidence",
    "daynight",
)

# The thermal contrast cannot be computed without these.
CRITICAL_COLUMNS = ("brightness", "bright_t31")

TARGET = "is_false_alarm"

# Model input, and its types (eleven predictors and the target).
MODEL_TABLE = T.StructType(
    [
        T.StructField("delta_t", T.DoubleType()),
        T.StructField("brightness", T.DoubleType()),
        T.StructField("bright_t31", T.DoubleType()),
        T.StructField("frp", T.DoubleType()),
        T.StructField("scan", T.DoubleType()),
        T.StructField("track", T.DoubleType()),
        T.StructField("month", T.ByteType()),
        T.StructField("hour", T.LongType()),
        T.StructField("is_night", T.ByteType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField(TARGET, T.ByteType()),
    ]
)

MODEL_COLUMNS = tuple(f.name for f in MODEL_TABLE)
PREDICTORS = tuple(c for c in MODEL_COLUMNS if c != TARGET)

# One row per timed run of one operation.
BENCH_RUNS = T.StructType(
    [
        T.StructField("backend", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("threads", T.IntegerType()),
        T.StructField("regime", T.StringType()),
        T.StructField("frac", T.DoubleType()),
        T.StructField("repetition", T.IntegerType()),
        T.StructField("time_s", T.DoubleType()),
        T.StructField("rows", T.LongType()),
        T.StructField("throughput_rows_s", T.DoubleType()),
        T.StructField("throughput_mb_s", T.DoubleType()),
        T.StructField("peak_mem_mb", T.DoubleType()),
        T.StructField("file_mb", T.DoubleType()),
        T.StructField("cores", T.IntegerType()),
        T.StructField("host", T.StringType()),
        T.StructField("python", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One row per training run on a CPU or a GPU.
DEVICE_RUNS = T.StructType(
    [
        T.StructField("dataset_pct", T.StringType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("model", T.StringType()),
        T.StructField("backend", T.StringType()),
        T.StructField("time_s", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("ram_peak_mb", T.DoubleType()),
        T.StructField("gpu_mem_peak_mb", T.DoubleType()),
        T.StructField("gpu_util_avg_pct", T.DoubleType()),
        T.StructField("nn_epochs", T.IntegerType()),
        T.StructField("node", T.StringType()),
        T.StructField("cpus", T.IntegerType()),
        T.StructField("session", T.LongType()),
        T.StructField("notes", T.StringType()),
        T.StructField("throughput_rows_s", T.DoubleType()),
    ]
)

# One row per trained model.
MODEL_METRICS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("train_time_s", T.DoubleType()),
        T.StructField("infer_time_s", T.DoubleType()),
        T.StructField("ram_peak_mb", T.DoubleType()),
        T.StructField("gpu_mem_peak_mb", T.DoubleType()),
        T.StructField("gpu_util_avg_pct", T.DoubleType()),
    ]
)

# One row per tried configuration.
SEARCH_RUNS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("config", T.StringType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("time_s", T.DoubleType()),
        T.StructField("n_estimators", T.DoubleType()),
        T.StructField("max_depth", T.DoubleType()),
        T.StructField("eta", T.DoubleType()),
        T.StructField("batch_size", T.DoubleType()),
        T.StructField("lr", T.DoubleType()),
    ]
)

# Headers of stored run files (left) and the names used here (right).
STORED_NAMES = {
    "operacion": "operation",
    "hilos": "threads",
    "escalabilidad": "regime",
    "repeticion": "repetition",
    "tiempo_s": "time_s",
    "filas_resultado": "rows",
    "throughput_filas_s": "throughput_rows_s",
    "memoria_pico_mb": "peak_mem_mb",
    "tam_archivo_mb": "file_mb",
    "nucleos_disponibles": "cores",
    "filas_train": "train_rows",
    "filas_test": "test_rows",
    "modelo": "model",
    "ram_pico_mb": "ram_peak_mb",
    "gpu_mem_pico_mb": "gpu_mem_peak_mb",
    "gpu_util_promedio_pct": "gpu_util_avg_pct",
    "epocas_red_neuronal": "nn_epochs",
    "nodo": "node",
    "cpus_asignadas": "cpus",
    "sesion_jupyter": "session",
    "notas": "notes",
    "throughput_reg_s": "throughput_rows_s",
    "tiempo_entrenamiento_s": "train_time_s",
    "tiempo_inferencia_s": "infer_time_s",
    "mes": "month",
    "hora": "hour",
    "es_noche": "is_night",
    "es_falsa_alarma": "is_false_alarm",
}

# Stored words for the two scaling regimes and the four operations.
STORED_VALUES = {
    "fuerte": "strong",
    "debil": "weak",
    "carga": "load",
    "filtro": "filter",
    "agregacion": "aggregate",
    "features": "features",
}
