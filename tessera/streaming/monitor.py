"""Continuous monitoring with Structured Streaming.

* ``monitor_stream`` - every micro-batch is tested against a static
  reference with the batch KS operator (``foreachBatch``), and its drift rows
  are written to ``<sink>/batch_id=<id>`` with overwrite: a replayed batch
  (after a failure) replaces its own output, so the sink is idempotent.
* ``windowed_metrics`` - confusion counts and accuracy per event-time window
  with a watermark for late rows, in append mode (a window is emitted once,
  after the watermark passes its end).  Event time must be TIMESTAMP (LTZ);
  TIMESTAMP_NTZ is cast first.
* ``window_counts`` - drift with state across micro-batches: counts by (event-time window, feature, value) live in
  the state store, merge with every micro-batch, and expire when the watermark passes their window.
* ``run_to_upserts`` / ``latest`` - a sink of updates: each micro-batch writes the rows that it changed to its own
  folder, and reading takes each key's last one.  Windows still open when the input ends are there too.
* ``with_open_windows`` - the windows still open when a stream of given events
  has ended, by a final batch pass.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import drift
from tessera.session import checkpoint_dir, cut_lineage


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def monitor_stream(stream: DataFrame, reference_long: DataFrame, features: list[str], sink: str,
                   checkpoint: str, alpha: float = 0.05, share_limit: float = 0.25,
                   available_now: bool = True):
    """Start the drift monitor; returns the StreamingQuery.

    The reference is counted once, before the first micro-batch, into the shared checkpoint folder.
    """
    reference_counts = cut_lineage(drift.value_counts(reference_long))

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        long = drift.to_long(batch_df, features).withColumn("batch", F.lit(int(batch_id)).cast("long"))
        ks = drift.ks_drift(reference_counts, long, alpha)
        summ = drift.drift_summary(ks, share_limit).select("batch", "drift_percentage", "dataset_drift")
        out = ks.join(summ, on="batch")
        out.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={int(batch_id)}"))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_monitor_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def windowed_metrics(stream: DataFrame, ts: str, label, pred, window: str = "1 day",
                     delay: str = "1 hour") -> DataFrame:
    """Streaming aggregate: per tumbling window, tp/fp/tn/fn, rows and accuracy."""
    return window_rows(event_time(stream, ts).withWatermark(ts, delay), ts, label, pred, window)


def window_rows(s: DataFrame, ts: str, label, pred, window: str) -> DataFrame:
    """The rows of ``windowed_metrics``, of a stream with a watermark or of a table."""
    y = (F.col(label) if isinstance(label, str) else label).cast("int")
    p = (F.col(pred) if isinstance(pred, str) else pred).cast("int")
    agg = s.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))
    return agg.select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "n", "tp", "fp", "tn", "fn",
                      ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"))


def run_to_table(agg: DataFrame, sink: str, checkpoint: str) -> None:
    """Append-mode parquet sink (exactly-once through its commit log), run to completion."""
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def with_open_windows(emitted: DataFrame, events: DataFrame, ts: str, label, pred, window: str = "1 day") -> DataFrame:
    """``emitted`` (a finished stream's windows) and, by one batch aggregate over the same events, the windows it
    lacks as the watermark never passed their end."""
    found = window_rows(event_time(events, ts).where(F.col(ts).isNotNull()), ts, label, pred, window)
    return emitted.unionByName(found.join(emitted.select("window_start"), on="window_start", how="left_anti"))


def window_counts(stream: DataFrame, features: list[str], ts: str, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Streaming (batch, feature, value, c_bat): value counts by event-time window (``batch`` is its start)."""
    timed = event_time(stream, ts).withWatermark(ts, delay).withColumn("__w", F.window(ts, window))
    long = drift.to_long(timed, features, ["__w"])
    counted = long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("__w", "feature", "value").agg(F.count(F.lit(1)).alias("c_bat"))
    return counted.select(F.date_format("__w.start", "yyyy-MM-dd HH:mm:ss").alias("batch"), "feature", "value", "c_bat")


def run_to_upserts(updates: DataFrame, sink: str, checkpoint: str) -> None:
    """Run a streaming aggregate to the end of its input; every micro-batch overwrites its own folder of changed rows."""
    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={int(batch_id)}"))

    q = (updates.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """The last row of each key in a sink of updates."""
    rows = spark.read.parquet(sink)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id").cast("long")).alias("__last"))
    return last.select(*keys, "__last.*")
