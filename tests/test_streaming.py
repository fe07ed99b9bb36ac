from datetime import datetime

from pegelwerk import streaming

SCHEMA = "messstelle string, zeit timestamp, levelDb double, label string, dBA double"


def run(spark, tmp_path, name, f):
    rows = [("a", datetime(2024, 7, 5, 8, 0, s % 60, 1000 * s), 60.0 + s % 3, "x" if s % 2 else "y", 70.0) for s in range(50)] + [("a", datetime(2024, 7, 5, 8, 0, 0), None, None, None), ("a", datetime(2024, 7, 5, 12, 0, 0), 60.0, "x", None)]
    spark.createDataFrame(rows, SCHEMA).repartition(1).write.parquet(str(tmp_path / "in"))
    q = f(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    return spark.table(name).collect()


def test_rollup(spark, tmp_path):
    rows = run(spark, tmp_path, "rollup", streaming.second_rollup)
    assert len(rows) == 50 and all(r.n == 1 for r in rows)


def test_sessions(spark, tmp_path):
    rows = run(spark, tmp_path, "sessions", streaming.sessions)
    assert [r.ereignisse for r in rows] == [51]


def test_bins(spark, tmp_path):
    rows = run(spark, tmp_path, "bins", streaming.bins)
    assert {r.label: r.clips for r in rows} == {"x": 25, "y": 25, None: 1}


def test_sliding(spark, tmp_path):
    rows = run(spark, tmp_path, "sliding", streaming.sliding_laeq)
    assert max(r.n for r in rows) == 50


def test_unchanged_folder_is_no_work(spark, tmp_path):
    a, cp, out = str(tmp_path / "a"), str(tmp_path / "cp2"), str(tmp_path / "out")
    spark.range(3).write.parquet(a)
    for _ in range(2):
        streaming.new_files(spark, a, "id long", cp, out).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    spark.range(2).write.mode("append").parquet(a)
    streaming.new_files(spark, a, "id long", cp, out).awaitTermination()
    assert spark.read.parquet(out).count() == 5
