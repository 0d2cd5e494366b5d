from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from emberline.operators.profile import class_balance
from emberline.plans.model_table import build_model_table
from emberline.registry import source_queries
from emberline.registry.views import bench_runs, detections
from emberline.schemas import BENCH_RUNS, DETECTIONS, MODEL_METRICS
from emberline.sources import audit, contract, drops, images, run_files, tables

HEADER = ",".join(f.name for f in DETECTIONS)


def line(time="0130", day="2026-01-02"):
    return f"1.5,2.5,300.0,0.4,0.5,{day},{time},N20,VIIRS,n,2.0NRT,280.0,3.5,D"


def drop(folder, name, *lines):
    (folder / name).write_text("".join(x + "\n" for x in lines))


def test_ingest_skips_empty_files(spark, tmp_path):
    drop(tmp_path, "firms_2026-01-01_10d.csv", HEADER, line(), line("abc"), line(""))
    drop(tmp_path, "firms_2026-01-11_10d.csv", HEADER)
    (tmp_path / "firms_2026-01-21_10d.csv").write_text("")
    drop(tmp_path, "notes.txt", "not a table")
    got = drops.ingest_csv(spark, str(tmp_path))
    assert got.drop(drops.CORRUPT).schema == DETECTIONS
    assert sorted((r.acq_time for r in got.collect()), key=str) == [130, None, None]
    assert got.first().acq_date == date(2026, 1, 2)


def test_other_columns_fail(spark, tmp_path):
    drop(tmp_path, "a.csv", HEADER.replace("frp", "power"), line())
    with pytest.raises(Exception):
        drops.ingest_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("days, want", [(1, [1]), (10, [10]), (11, [10, 1]), (25, [10, 10, 5])])
def test_window_plan(spark, days, want):
    bounds = spark.createDataFrame([(date(2026, 1, 1),)], "start date").withColumn("end", F.date_add("start", days - 1))
    got = drops.plan_windows(bounds).orderBy("window_start").collect()
    assert [r.days for r in got] == want
    assert got[0].window_start == date(2026, 1, 1)


def test_only_full_files_count_as_landed(spark, tmp_path):
    drop(tmp_path, "firms_2026-01-01_10d.csv", HEADER)
    (tmp_path / "firms_2026-01-11_10d.csv").write_text("")
    drop(tmp_path, "firms_2026-01-21_04d.csv", HEADER)
    bounds = spark.createDataFrame([(date(2026, 1, 1), date(2026, 1, 25))], "start date, end date")
    left = drops.pending_windows(drops.plan_windows(bounds), drops.landed_windows(spark, str(tmp_path)))
    assert sorted((str(r.window_start), r.days) for r in left.collect()) == [("2026-01-11", 10), ("2026-01-21", 5)]
    name = spark.range(1).select(drops.drop_name(F.lit("2026-01-21").cast("date"), F.lit(4))).first()[0]
    assert name == "firms_2026-01-21_04d.csv"


def test_areas(spark):
    df = spark.createDataFrame([(10.0, -84.0), (50.0, -100.0), (-10.0, 20.0)], "latitude double, longitude double")
    assert drops.filter_area(df, "costa-rica").count() == 1
    assert drops.filter_area(df, "norteamerica").count() == 1
    assert drops.filter_area(df, "world").count() == drops.filter_area(df, "mundo").count() == 3
    assert drops.filter_area(df, "20,-10,21,-9").count() == 1


def test_audit_verdicts(spark, tmp_path):
    tables.write_table(spark.range(100).coalesce(1), str(tmp_path / "t"))
    good = next((tmp_path / "t").glob("*.parquet"))
    data = good.read_bytes()
    (tmp_path / "cut.parquet").write_bytes(data[: len(data) // 2])
    (tmp_path / "tiny.parquet").write_bytes(b"PAR1PAR1PAR")
    (tmp_path / "head.parquet").write_bytes(b"XXXX" + data[4:])
    (tmp_path / "foot.parquet").write_bytes(data[:-12] + b"\x07" * 8 + b"PAR1")
    (tmp_path / "body.parquet").write_bytes(data[:4] + b"\xff" * 60 + data[64:])
    names = ["cut", "tiny", "head", "foot", "body", "gone"]
    paths = [str(good), *[str(tmp_path / f"{n}.parquet") for n in names]]
    got = {r.path.split("/")[-1].split(".")[0]: r for r in audit.audit_parquet(spark, paths).collect()}
    assert [got[n].status for n in names] == ["truncated", "too_small", "bad_header", "bad_footer", "unreadable", "missing"]
    whole = next(r for r in got.values() if r.status == "ok")
    assert (whole.rows, whole.columns, whole.row_groups, whole.has_background) == (100, 1, 1, False)
    listed = audit.audit_folder(spark, str(tmp_path)).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in listed}["ok"] == 1 and sum(r["count"] for r in listed) == 6


def test_audit_of_tables_of_several_files(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "whole"))
    spark.range(90).repartition(3).write.parquet(str(tmp_path / "hurt"))
    hurt = sorted((tmp_path / "hurt").glob("*.parquet"))[1]
    hurt.write_bytes(hurt.read_bytes()[:-20])
    (tmp_path / "bare").mkdir()
    names = ["whole", "hurt", "bare", "gone"]
    got = {r.path.split("/")[-1]: r for r in audit.audit_parquet(spark, [str(tmp_path / n) for n in names]).collect()}
    assert [got[n].status for n in names] == ["ok", "truncated", "missing", "missing"]
    assert (got["whole"].rows, got["whole"].columns, got["whole"].row_groups) == (100, 1, 3)


def test_audit_in_a_store_that_only_spark_reads(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "whole"))
    spark.range(0).coalesce(1).write.parquet(str(tmp_path / "none"))
    spark.range(90).repartition(3).write.parquet(str(tmp_path / "hurt"))
    hurt = sorted((tmp_path / "hurt").glob("*.parquet"))[1]
    hurt.write_bytes(hurt.read_bytes()[:-20])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.audited.link./in", f"file://{tmp_path}")
    names = ["whole", "none", "hurt", "gone"]
    paths = [f"viewfs://audited/in/{n}" for n in names]
    got = {r.path.split("/")[-1]: r for r in audit.audit_parquet(spark, paths).collect()}
    assert [(got[n].status, got[n].rows) for n in names[:2]] == [("ok", 100), ("ok", 0)]
    assert [got[n].status for n in names[2:]] == ["bad_footer", "missing"]


def test_audit_finds_damage_in_a_later_row_group(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / "groups.parquet"
    pq.write_table(pa.table({"a": list(range(4000))}), path, row_group_size=1000, compression="none", use_dictionary=False)
    place = pq.ParquetFile(path).metadata.row_group(3).column(0).data_page_offset
    data = bytearray(path.read_bytes())
    data[place : place + 60] = b"\xff" * 60
    path.write_bytes(bytes(data))
    assert audit.audit_parquet(spark, [str(path)]).first().status == "unreadable"


def test_contract(spark):
    df = spark.createDataFrame([(95.0, "25", None), (10.0, "l", 5.0)], "latitude double, confidence string, brightness float")
    got = {r.column: r for r in contract.contract_report(df, DETECTIONS).collect()}
    assert (got["latitude"].status, got["latitude"].outside_domain) == ("ok", 1)
    assert (got["confidence"].status, got["confidence"].outside_domain) == ("ok", 1)
    assert (got["brightness"].status, got["brightness"].critical) == ("other_type", True)
    assert got["bright_t31"].status == "missing" and got["bright_t31"].critical
    diff = contract.column_difference(df.withColumn("more", F.lit(1)), DETECTIONS).first()
    assert diff.extra == ["more"] and "frp" in diff.missing
    assert contract.target_column(df) == "brightness"


def test_select_required_takes_what_is_there(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "frp double, latitude double, other int")
    assert tables.select_required(df).columns == ["latitude", "frp"]


def test_image_manifest(spark, tmp_path):
    for split, label, n in (("train", "wildfire", 3), ("train", "nowildfire", 2), ("test", "wildfire", 1)):
        folder = tmp_path / split / label
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"{i}.jpg").write_bytes(b"x" * (i + 1))
        (folder / "readme.txt").write_text("no image")
    manifest = images.image_manifest(spark, str(tmp_path))
    got = {(r.split, r.label): r.n for r in images.manifest_counts(manifest).collect()}
    assert got == {("train", "wildfire"): 3, ("train", "nowildfire"): 2, ("test", "wildfire"): 1}
    assert manifest.agg(F.max("length")).first()[0] == 3
    assert "content" not in manifest._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_vectors_of_one_file_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_queries, "TASK_FILES", 20)
    rows = spark.range(60).selectExpr("id AS vec_id", "array(cast(id as float)) AS embedding", "cast(id % 3 as int) AS label")
    rows.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    folder = Path(source_queries.image_folder(spark, str(tmp_path)).removeprefix("file:"))
    files = [f for f in folder.rglob("*") if f.is_file() and f.name != "_SUCCESS"]
    assert sorted(f.read_text() for f in files) == sorted(f"{k}.0\n" for k in range(60))
    assert len({f.name.split("-")[1] for f in files}) == 3
    counts = source_queries.manifest(spark, str(tmp_path)).collect()
    assert sum(r.n for r in counts) == 60 and {r.label for r in counts} == {0, 1, 2}


def test_runs_are_appended_and_read(spark, small, tmp_path):
    path = str(tmp_path / "runs")
    assert run_files.read_runs(spark, path).count() == 0
    runs = bench_runs(spark, small)
    run_files.append_runs(runs, path)
    run_files.append_runs(runs, path)
    got = run_files.read_runs(spark, path)
    assert got.schema == BENCH_RUNS and got.count() == 2 * runs.count()
    assert got.select("host").distinct().first().host is None


def test_stored_words_become_ours(spark, tmp_path):
    (tmp_path / "r.csv").write_text("backend,operacion,hilos,escalabilidad,tiempo_s,otra\npolars,agregacion,4,fuerte,0.613,x\n")
    r = run_files.read_runs(spark, str(tmp_path)).first()
    assert (r.backend, r.operation, r.threads, r.regime, r.time_s, r.rows) == ("polars", "aggregate", 4, "strong", 0.613, None)


def test_metric_documents(spark, tmp_path):
    path = str(tmp_path / "m")
    metrics = spark.createDataFrame([("RF", 0.9, 0.7, 0.8, 0.75, 0.98, 100.0, 3.0, None, None, None)], MODEL_METRICS)
    run_files.write_metrics_json(metrics, path)
    assert run_files.read_metrics_json(spark, path, MODEL_METRICS).collect() == metrics.collect()
    assert run_files.read_metrics_json(spark, str(tmp_path / "none"), MODEL_METRICS).count() == 0
    (tmp_path / "doc.json").write_text('{\n  "model": "CNN",\n  "f1": 0.96\n}')
    one = run_files.read_metrics_json(spark, str(tmp_path / "doc.json"), lines=False).first()
    assert (one.model, one.f1) == ("CNN", 0.96)
    (tmp_path / "best.json").write_text('{\n "Random Forest": "{\'max_depth\': 16}",\n "XGBoost": "{\'eta\': 0.3}"\n}')
    best = {r.model: r.config for r in run_files.read_best_configs(spark, str(tmp_path / "best.json")).collect()}
    assert best == {"Random Forest": "{'max_depth': 16}", "XGBoost": "{'eta': 0.3}"}


def test_model_table_is_written_and_read_back(spark, small, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    tables.write_table(detections(spark, small), raw)
    balance = build_model_table(spark, raw, out)
    assert spark.read.parquet(out).columns[-1] == "is_false_alarm" and len(spark.read.parquet(out).columns) == 12
    assert balance.collect() == class_balance(spark.read.parquet(out)).collect()
    assert list((tmp_path / "out").glob("*.snappy.parquet"))


def test_lines_that_do_not_fit_are_kept_and_marked(spark, tmp_path):
    drop(tmp_path, "a.csv", HEADER, line(), line().replace("300.0", "hot"), "1.5,2.5,300.0", line() + ",more")
    got = drops.ingest_csv(spark, str(tmp_path)).collect()
    marked = [r for r in got if r[drops.CORRUPT] is not None]
    assert len(got) == 4 and len(marked) == 3
    assert {r[drops.CORRUPT] for r in marked} == {line().replace("300.0", "hot"), "1.5,2.5,300.0", line() + ",more"}
    assert next(r for r in marked if "hot" in r[drops.CORRUPT]).frp == 3.5


def test_whole_numbers_with_a_decimal_point(spark, tmp_path):
    (tmp_path / "runs.csv").write_text(
        "backend,threads,time_s,rows\npolars,8.0,1.5,11026780.0\ndask,8.5,2,x\npandas,,3,9007199254740993\n"
    )
    got = {r.backend: r for r in run_files.read_runs(spark, str(tmp_path)).collect()}
    assert (got["polars"].threads, got["polars"].rows) == (8, 11026780)
    assert got["dask"].threads is None and got["dask"].rows is None
    assert got["pandas"].threads is None and got["pandas"].rows == 9007199254740993
    lost = {r.column: r.n for r in run_files.unparsed_values(spark, str(tmp_path)).collect()}
    assert lost == {"backend": 0, "threads": 1, "time_s": 0, "rows": 1}


def test_positions_over_many_files_shuffle_no_rows(spark, tmp_path):
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "t"))
    placed = tables.with_file_position(spark, str(tmp_path / "t"))
    assert sorted(r.position for r in placed.collect()) == list(range(1000))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from emberline import session

    for master, fails in (("yarn", True), ("spark://host:7077", True), ("local-cluster[2,1,1024]", True), ("local[8]", False)):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
        if fails:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                session.shared_folder(fake)
        else:
            assert session.shared_folder(fake)


def test_schema_from_first_lines(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.csv").write_text("n,x,d,t,mixed,empty\n1,2,2024-01-31,2024-01-31,5,\n-3,,2024-02-29,1,6,\n")
    (folder / "b.csv").write_text("n,x,d,t,mixed,empty\n7,1.5e3,2023-12-01,x,abc,\n")
    (folder / "c.csv").write_text("")
    schema = drops.infer_schema(spark, str(folder))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("n", "bigint"), ("x", "double"), ("d", "date"), ("t", "string"), ("mixed", "string"), ("empty", "string")
    ]
    assert drops.infer_schema(spark, str(folder), 1)["x"].dataType.simpleString() == "double"
    (folder / "b.csv").write_text("n,x,d,t,mixed,empty\n7,9,2023-12-01,x,8,\nq,1.5,2023-02-30,x,abc,\n")
    first = drops.infer_schema(spark, str(folder), 1)
    assert [first[c].dataType.simpleString() for c in ("n", "x", "d", "mixed")] == ["bigint", "bigint", "date", "bigint"]
    whole = drops.infer_schema(spark, str(folder))
    assert [whole[c].dataType.simpleString() for c in ("n", "x", "d", "mixed")] == ["string", "double", "string", "string"]
    read = spark.read.schema(whole).options(**drops.csv_options(None)).csv(str(folder))
    assert read.count() == 4
