"""Bindings of the streaming monitors: ``events`` parquet read as a file stream."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.operators import drift
from tessera.plans import monitoring as MON
from tessera.plans.common import rounded
from tessera.streaming import monitor as SM

DELAY = "1 hour"
STATE_FILES = 4
STATE_WINDOW = "10 days"


def event_stream(spark, sf):
    schema = spark.read.parquet(os.path.join(sf, "events.parquet")).schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
         .parquet(sf))
    return s.withColumns({"k": F.get_json_object("props", "$.k").try_cast("double"),
                          "user_id": F.col("user_id").cast("double")})


def q_stream_drift(spark, sf):
    ref = drift.to_long(MON.reference_rows(spark, sf), MON.FEATURES)
    later = event_stream(spark, sf).where(F.col("ts") >= F.lit(MON.CUTOFF).cast("timestamp_ntz"))
    sink = SM.scratch_path(spark, "drift")
    q = SM.monitor_stream(later, ref, MON.FEATURES, sink, sink + "-ckpt")
    q.awaitTermination()
    out = SM.read_monitor_sink(spark, sink)
    return rounded(out.select(F.col("batch_id").cast("long").alias("batch_id"), "feature", "n_ref", "n_batch",
                              "statistic", "p_value", "drifted", "drift_percentage", "dataset_drift"))


def _window_columns():
    return F.col("event_type") == "purchase", F.coalesce(F.col("value") > 100, F.lit(False))


def _closed_windows(spark, sf):
    agg = SM.windowed_metrics(event_stream(spark, sf), "ts", *_window_columns(), "1 day", DELAY)
    sink = SM.scratch_path(spark, "windows")
    SM.run_to_table(agg, sink, sink + "-ckpt")
    return spark.read.parquet(sink)


def q_stream_window_metrics(spark, sf):
    """Every window, the last one included: each micro-batch writes the windows that it changed."""
    agg = SM.windowed_metrics(event_stream(spark, sf), "ts", *_window_columns(), "1 day", DELAY)
    sink = SM.scratch_path(spark, "window-updates")
    SM.run_to_upserts(agg, sink, sink + "-ckpt")
    return rounded(SM.latest(spark, sink, ["window_start"]))


def q_stream_drift_state(spark, sf):
    """KS of each ten-day window against the reference, from counts kept in state over several micro-batches."""
    folder = SM.scratch_path(spark, "events")
    events = spark.read.parquet(os.path.join(sf, "events.parquet"))
    events.repartition(STATE_FILES, "event_id").write.parquet(folder)
    later = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
             .withColumns({"k": F.get_json_object("props", "$.k").try_cast("double"), "user_id": F.col("user_id").cast("double")})
             .where(F.col("ts") >= F.lit(MON.CUTOFF).cast("timestamp_ntz")))
    sink = SM.scratch_path(spark, "drift-state")
    # files come in any order of time: the delay covers the whole table
    SM.run_to_upserts(SM.window_counts(later, MON.FEATURES, "ts", STATE_WINDOW, "366 days"), sink, sink + "-ckpt")
    counts = SM.latest(spark, sink, ["batch", "feature", "value"])
    reference = drift.to_long(MON.reference_rows(spark, sf), MON.FEATURES)
    return rounded(drift.ks_drift(reference, counts).select("batch", "feature", "n_ref", "n_batch", "statistic", "p_value", "drifted"))


def q_stream_window_metrics_all(spark, sf):
    """Closed windows in append mode, and the windows still open at the end by a final batch pass."""
    events = spark.read.parquet(os.path.join(sf, "events.parquet"))
    return rounded(SM.with_open_windows(_closed_windows(spark, sf), events, "ts", *_window_columns(), "1 day"))


QUERIES = {
    "stream_drift": q_stream_drift,
    "stream_drift_state": q_stream_drift_state,
    "stream_window_metrics": q_stream_window_metrics,
    "stream_window_metrics_all": q_stream_window_metrics_all,
}

_LATER_LONG = f"""
later_all AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{MON.CUTOFF}'),
ref_long AS (SELECT 'value' AS feature, value FROM ref_rows UNION ALL SELECT 'k', k FROM ref_rows
             UNION ALL SELECT 'user_id', user_id FROM ref_rows),
bat_long AS (SELECT 0 AS batch, 'value' AS feature, value FROM later_all UNION ALL SELECT 0, 'k', k FROM later_all
             UNION ALL SELECT 0, 'user_id', user_id FROM later_all),
"""

_WINDOWS = """WITH e AS (SELECT date_trunc('day', ts) AS ws, CAST(event_type = 'purchase' AS INTEGER) AS y,
    CAST(coalesce(value > 100, false) AS INTEGER) AS p FROM events WHERE ts IS NOT NULL)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(count(*) AS BIGINT) AS n,
  CAST(count_if(y = 1 AND p = 1) AS BIGINT) AS tp, CAST(count_if(y = 0 AND p = 1) AS BIGINT) AS fp,
  CAST(count_if(y = 0 AND p = 0) AS BIGINT) AS tn, CAST(count_if(y = 1 AND p = 0) AS BIGINT) AS fn,
  round(CAST(count_if(y = p) AS DOUBLE) / count(*), 6) AS accuracy
FROM e GROUP BY ws"""

ORACLE = {
    "stream_drift": "WITH " + MON.EVENTS_CTE + "," + _LATER_LONG + MON.ks_sql("ref_long", "bat_long") + """,
s AS (SELECT batch, CAST(count_if(p_value < 0.05) AS DOUBLE) / count(*) AS share FROM ks GROUP BY batch)
SELECT CAST(ks.batch AS BIGINT) AS batch_id, feature, n_ref, n_batch, round(statistic, 6) AS statistic,
  round(p_value, 6) AS p_value, p_value < 0.05 AS drifted, round(s.share, 6) AS drift_percentage,
  s.share > 0.25 AS dataset_drift
FROM ks JOIN s ON ks.batch = s.batch""",
    "stream_drift_state": "WITH " + MON.EVENTS_CTE + """,
later_all AS (SELECT *, strftime(time_bucket(INTERVAL 10 DAYS, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS batch
              FROM ev WHERE ts >= TIMESTAMP '""" + MON.CUTOFF + """'),
ref_long AS (SELECT 'value' AS feature, value FROM ref_rows UNION ALL SELECT 'k', k FROM ref_rows
             UNION ALL SELECT 'user_id', user_id FROM ref_rows),
bat_long AS (SELECT batch, 'value' AS feature, value FROM later_all UNION ALL SELECT batch, 'k', k FROM later_all
             UNION ALL SELECT batch, 'user_id', user_id FROM later_all),
""" + MON.ks_sql("ref_long", "bat_long") + """
SELECT batch, feature, n_ref, n_batch, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  p_value < 0.05 AS drifted FROM ks""",
    "stream_window_metrics": _WINDOWS,
    "stream_window_metrics_all": _WINDOWS,
}
