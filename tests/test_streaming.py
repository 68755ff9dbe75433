import pytest

from lumenmap.operators import evolution as V
from lumenmap.streaming import ledger as L

EVENTS = "point_id long, session string, visible boolean, matched boolean"
ROWS = [(1, "s1", True, True), (2, "s1", True, False), (1, "s3", True, False), (1, "s2", True, False), (2, "s2", True, False), (3, "s2", False, False), (1, "s3", True, True), (2, "s2", True, False)]


def run(spark, rows, schema, path, make, name, per_file=2):
    for i in range(0, len(rows), per_file):
        spark.createDataFrame(rows[i : i + per_file], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = make(stream).writeStream.outputMode("update").format("memory").queryName(name).option("checkpointLocation", path + "-state").start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name).collect()


def test_stream_ledger_ends_as_batch(spark, tmp_path):
    got = run(spark, ROWS, EVENTS, str(tmp_path / "a"), L.stream_ledger, "ledger_updates")
    want = {r["point_id"]: r for r in V.ledger(spark.createDataFrame(ROWS, EVENTS)).collect()}
    for k, w in want.items():
        last = [r for r in got if r["point_id"] == k][-1]
        assert last["state"] == w["state"] and last["unmatched_streak"] == w["unmatched_streak"] and last["stability"] == pytest.approx(w["stability"]) and last["consistency"] == pytest.approx(w["consistency"])


def test_stream_memory_ends_as_batch(spark, tmp_path):
    schema = "feature_id long, ts double, event string"
    rows = [(1, 3.0, "CORRECT"), (1, 1.0, "INCORRECT"), (2, 1.0, "UNMATCHED"), (1, 2.0, "CORRECT"), (2, 0.5, "CORRECT")]
    got = run(spark, rows, schema, str(tmp_path / "m"), L.stream_memory, "memory_updates")
    want = {r["feature_id"]: r["score"] for r in V.feature_memory(spark.createDataFrame(rows, schema)).collect()}
    assert {k: [r for r in got if r["feature_id"] == k][-1]["score"] for k in want} == pytest.approx(want)
