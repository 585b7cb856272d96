import datetime as dt

from ledgerloom.streaming.day_barrier import rolling_modes


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, d, h), c, x) for i, (d, h, c, x) in enumerate([(1, 1, "X", "A"), (2, 1, "X", "B"), (2, 2, "X", "B"), (3, 1, "X", "A"), (3, 1, "Y", "C"), (9, 1, "Z", "Q"), (12, 1, "Z", "Q")])]
    schema = "id long, ts timestamp, content string, label string"
    for k, part in enumerate((rows[:3], rows[3:6], rows[6:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{k}")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in/*")
    q = rolling_modes(s).writeStream.format("memory").queryName("barrier").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.id: (r.pred, r.hist_n) for r in spark.table("barrier").collect()}
    want = {0: (None, 0), 1: ("A", 1), 2: ("A", 1), 3: ("B", 3), 4: (None, 0)}
    assert {k: v for k, v in got.items() if k in want} == want
