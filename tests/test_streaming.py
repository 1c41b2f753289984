import os

from leafwork.streaming import events

SF = "/root/testdata/sf0.001"


def test_windowed_counts(spark):
    stream = events.counts(events.read_events(spark, SF, "events.parquet"))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from hourly").first()[0] == spark.read.parquet(os.path.join(SF, "events.parquet")).count()


def test_upsert_and_reserve(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    a = spark.createDataFrame([("k", 1, "old"), ("m", 1, "x")], "key string, at int, v string")
    b = spark.createDataFrame([("k", 2, "new")], "key string, at int, v string")
    for batch in (a, b, b):
        events.upsert_latest(batch, store, "key", "at")
    assert sorted(tuple(r) for r in events.current(spark, store)[1].collect()) == [("k", 2, "new"), ("m", 1, "x")]
    ledger = f"file://{tmp_path}/ledger"
    want = spark.createDataFrame([("r", "p1"), ("r", "p2")], "reservation_id string, page_id string")
    more = spark.createDataFrame([("s", "p2"), ("s", "p3"), ("s", "p4")], "reservation_id string, page_id string")
    assert [events.reserve(x, ledger, 3) for x in (want, want, more)] == [2, 0, 0]
    assert events.reserve(more, ledger, 4) == 2
