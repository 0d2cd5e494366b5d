from emberline.streaming.ingest import ingest_stream
from test_sources import HEADER, drop, line


def test_each_file_is_taken_once(spark, tmp_path):
    folder, out, log = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "log")
    folder.mkdir()

    def run():
        ingest_stream(spark, str(folder), out, log, max_files=1).awaitTermination()
        return sorted((r.ingested_from, r.acq_time) for r in spark.read.parquet(out).collect())

    drop(folder, "a.csv", HEADER, line("0100"), line("0200"))
    drop(folder, "b.csv", HEADER, line("0300"))
    assert run() == [("a.csv", 100), ("a.csv", 200), ("b.csv", 300)]
    assert len(run()) == 3
    drop(folder, "c.csv", HEADER, line("bad"))
    assert [x for x in run() if x[0] == "c.csv"] == [("c.csv", None)]
    assert len(run()) == 4
