"""Time the four operations on a stored table with 1, 2, 4 ... cores and print a table.

    python tools/scaling.py /root/testdata/sf0.1 /tmp/run-x/detections 20 1,2,4,8

The table is the detections of the given folder, repeated with shifted order keys and written as
several files, so that every core has files to read. Each core count runs in a process of its own.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from bench import OPERATIONS, measure, run_once, session


def prepare(sf_dir: str, path: str, copies: int) -> None:
    from pyspark.sql import functions as F

    from emberline.registry.views import detections_of, table

    if os.path.exists(path):
        return
    spark = session(8)
    shifts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    lines = table(spark, sf_dir, "lineitem").withColumn("_copy", shifts).repartition(32)
    shifted = lines.withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * 1_000_003).drop("_copy")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    detections_of(shifted).drop(*keys).write.parquet(path)
    spark.stop()


def one(path: str, cpus: int) -> None:
    from emberline.plans.benchmark import OPERATIONS as PLANS
    from emberline.sources.tables import scan_detections

    spark = session(cpus)
    rows = scan_detections(spark, path).count()
    times = {n: measure(lambda n=n: run_once(PLANS[n](scan_detections(spark, path))), 3) for n in OPERATIONS}
    spark.stop()
    print(json.dumps({"cpus": cpus, "rows": rows, "times": times}))


def main() -> None:
    if sys.argv[1] == "--one":
        return one(sys.argv[2], int(sys.argv[3]))
    sf_dir, path, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    counts = [int(x) for x in sys.argv[4].split(",")]
    first = subprocess.run(
        [sys.executable, "-c", f"import sys; sys.path.insert(0, {os.path.dirname(os.path.abspath(__file__))!r}); "
         f"import scaling; scaling.prepare({sf_dir!r}, {path!r}, {copies})"],
        check=True,
    )
    del first
    found = []
    for n in counts:
        out = subprocess.run([sys.executable, __file__, "--one", path, str(n)], capture_output=True, text=True, check=True)
        found.append(json.loads(out.stdout.strip().splitlines()[-1]))
    base = found[0]
    print("| operation | cores | seconds | million rows/s | speedup | efficiency |\n|---|---|---|---|---|---|")
    for op in OPERATIONS:
        for f in found:
            t = f["times"][op]
            s = base["times"][op] * base["cpus"] / t
            print(f"| {op} | {f['cpus']} | {t:.2f} | {f['rows'] / t / 1e6:.2f} | {s:.2f} | {100 * s / f['cpus']:.0f} % |")


if __name__ == "__main__":
    main()
