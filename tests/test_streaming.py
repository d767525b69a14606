from pyspark.sql import functions as F

from leafgauge import streaming


def test_windows_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # The second batch repeats part of the first.
    events.where("event_id % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "in"))
    events.where("event_id % 2 = 1 or event_id % 10 = 0").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streaming.windowed_counts(stream, late="10000 days").writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = sorted(map(tuple, streaming.windowed_counts(events).collect()))
    assert sorted(map(tuple, spark.table("w").collect())) == want and len(want) > 100


def test_sessions(spark):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:20:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 00:00:00")]
    e = spark.createDataFrame(rows, "user_id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r["user_id"], r["n"]) for r in streaming.sessions(e).collect()) == [(1, 1), (1, 2), (2, 1)]
