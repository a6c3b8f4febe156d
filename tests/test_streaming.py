import datetime as dt

from strataframe.streaming import ingest


def test_deliveries_come_once(spark, tmp_path):
    schema = "key string, status string, loaded_at timestamp"
    rows = [("a", "ok", dt.datetime(2024, 1, 1)), ("a", "ok", dt.datetime(2024, 1, 2)), ("b", "ok", dt.datetime(2024, 1, 1))]
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    ingest.ingest(ingest.deliveries(spark, src, schema), lambda d: d.select("key"), out, ck).awaitTermination(60)
    spark.createDataFrame([("a", "ok", dt.datetime(2024, 1, 3)), ("c", "ok", dt.datetime(2024, 1, 3))], schema).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest(ingest.deliveries(spark, src, schema), lambda d: d.select("key"), out, ck).awaitTermination(60)
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_windows(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 5), 1, "x"), (dt.datetime(2024, 1, 1, 0, 15), 1, "x"), (dt.datetime(2024, 1, 1, 2), 1, "y")]
    e = spark.createDataFrame(rows, "ts timestamp, user_id long, event_type string")
    assert sorted((r.event_type, r.n) for r in ingest.tumbling(e).collect()) == [("x", 2), ("y", 1)]
    assert sorted(r.n for r in ingest.sessions(e).collect()) == [1, 2]
