"""Drift counts kept across micro-batches, their expiry, and a restart."""
import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.operators import drift
from tessera.streaming import monitor as SM

SCHEMA = "ts timestamp, x double, y double"


def batch(seed, day, n=40):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, day)
    return [(start + dt.timedelta(hours=rng.randrange(24)), rng.choice([1.0, 2.0, float("nan"), None, 5.0 + seed]), rng.random()) for _ in range(n)]


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, sink, delay="2 days"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    SM.run_to_upserts(SM.window_counts(stream, ["x", "y"], "ts", "1 day", delay), sink, sink + "-ckpt")


def values(df):
    return sorted((str(r.batch), r.feature, r.n_ref, r.n_batch, round(r.statistic, 9), round(r.p_value, 9)) for r in df.collect())


def test_micro_batches_and_a_restart_equal_one_batch(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    rows = [batch(i, 1 + i // 2) for i in range(6)]
    for part in rows[:4]:
        put(spark, folder, part)
    run(spark, folder, sink)
    for part in rows[4:]:
        put(spark, folder, part)
    run(spark, folder, sink)  # goes on from its checkpoint, with the counts so far
    run(spark, folder, sink)  # nothing new
    assert spark.read.parquet(sink).select("batch_id").distinct().count() >= 6
    every = spark.createDataFrame([r for part in rows for r in part], SCHEMA)
    ref = drift.to_long(spark.createDataFrame(batch(99, 1, 90), SCHEMA), ["x", "y"])
    long = drift.to_long(every.withColumn("batch", F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss")), ["x", "y"], ["batch"])
    got = drift.ks_drift(ref, SM.latest(spark, sink, ["batch", "feature", "value"]))
    assert values(got) == values(drift.ks_drift(ref, long))


def test_counts_expire_with_the_watermark(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    put(spark, folder, batch(1, 1))
    run(spark, folder, sink, "1 hour")
    put(spark, folder, batch(2, 9))
    run(spark, folder, sink, "1 hour")
    put(spark, folder, [(dt.datetime(2024, 1, 1, 5), 1.0, 1.0)])  # too late: its window is gone
    run(spark, folder, sink, "1 hour")
    held = SM.latest(spark, sink, ["batch", "feature", "value"])
    assert held.where("batch = '2024-01-01 00:00:00' and feature = 'y'").agg(F.sum("c_bat")).first()[0] == 40


def test_open_windows_are_in_the_sink(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    for i in range(3):
        put(spark, folder, batch(i, 1 + i))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    SM.run_to_upserts(SM.windowed_metrics(stream, "ts", F.col("x") == 1.0, F.col("y") > 0.5, "1 day", "3 days"), sink, sink + "-ckpt")
    got = {r.window_start[:10]: r.n for r in SM.latest(spark, sink, ["window_start"]).collect()}
    assert got == {f"2024-01-0{d}": 40 for d in (1, 2, 3)}
