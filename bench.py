"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS     cores of the local session (default: all)
    BENCH_QUERIES  names to run, separated by commas (default: the list below)
    BENCH_REPEAT   timed runs per query, the median counts (default 1)
    BENCH_SCALING  core counts separated by commas: also prints speedup and efficiency against one
                   core, in a process of its own per count
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

OPERATIONS = ("load", "filter", "aggregate", "features")

QUERIES = (
    "satellite_month",
    "model_table",
    "clean_detections",
    "quality_breakdown",
    "null_profile",
    "daily_series",
    "hourly_counts",
    "grid_density",
    "top_cells",
    "confidence_distribution",
    "contrast_by_confidence",
    "class_balance",
    "frp_stats",
    "histogram",
    "clip_upper",
    "correlation_matrix",
    "every_kth",
    "exact_fraction",
    "stratified_split",
    "exact_stratified_split",
    "summarise_runs",
    "summary_table",
    "device_speedup",
    "scaling_index",
    "fastest_within_tolerance",
    "confusion_matrix",
    "classification_report",
    "roc_auc",
    "roc_points_thinned",
    "threshold_rule",
    "standardise",
    "ingest_csv",
)


def session(cpus: int):
    from emberline.session import build_session

    spark = build_session(
        "emberline-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_once(df) -> None:
    """Compute every row and column of the result without storing it."""
    df.write.format("noop").mode("overwrite").save()


def measure(work, repeat: int) -> float:
    work()  # code generation and file caches
    times = []
    for _ in range(repeat):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def run(sf_dir: str, cpus: int, names: list[str], repeat: int) -> dict[str, float]:
    from emberline.plans.benchmark import OPERATIONS as PLANS
    from emberline.registry import BOOK
    from emberline.registry.views import detections

    spark = session(cpus)
    times = {}
    for name in names:
        if name in OPERATIONS:
            work = lambda n=name: run_once(PLANS[n](detections(spark, sf_dir)))
        else:
            work = lambda n=name: run_once(BOOK[n].query(spark, sf_dir))
        times[name] = round(measure(work, repeat), 4)
    spark.stop()
    return times


def scaling(counts: list[int]) -> dict[str, dict[str, float]]:
    """Speedup and efficiency per query against one core; every count runs in a fresh process."""
    found = {}
    for n in counts:
        env = {**os.environ, "BENCH_CPUS": str(n), "BENCH_SCALING": ""}
        out = subprocess.run([sys.executable, os.path.join(HERE, "bench.py")], env=env, capture_output=True, text=True)
        found[n] = json.loads(out.stdout.strip().splitlines()[-1])["queries"]
    table = {}
    for n, times in found.items():
        for name, seconds in times.items():
            single = found[min(found)][name] * min(found)
            table.setdefault(name, {})[f"{n}"] = {
                "sec": seconds,
                "speedup": round(single / seconds, 2),
                "efficiency": round(single / seconds / n, 2),
            }
    return table


def main() -> None:
    counts = [int(x) for x in os.environ.get("BENCH_SCALING", "").split(",") if x]
    if counts:
        print(json.dumps({"metric": "scaling", "queries": scaling(counts)}))
        return
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*OPERATIONS, *QUERIES]
    times = run(sf_dir, cpus, names, repeat)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
