"""Monitoring bindings on ``events``.

Reference period: ``ts`` before 2024-01-16.  Later rows, in (ts, event_id)
order, form 5 contiguous batches of n // 5 rows (the remainder of at most 4
rows is left out, as the batch rule says; no size cap is applied).
Batch 5 gets the column shift, as in the reference's simulated production run.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.kolmogorov import SWITCH, TERMS
from tessera.operators import drift, metrics
from tessera.operators.sampling import batch_slice
from tessera.plans.common import rounded, table

CUTOFF = "2024-01-16 00:00:00"
N_BATCHES = 5
FEATURES = ["value", "k", "user_id"]
SHIFT_BATCH = 5


def _events(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return ev.withColumns({
        "k": F.get_json_object("props", "$.k").try_cast("double"),
        "user_id": F.col("user_id").cast("double"),
    }).drop("props")


def _cut():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def reference_rows(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).where(F.col("ts") < _cut())


def batch_rows(spark, sf_dir) -> DataFrame:
    later = _events(spark, sf_dir).where(F.col("ts") >= _cut())
    return batch_slice(later, ["ts", "event_id"], N_BATCHES, max_size=None)


def shifted_batches(spark, sf_dir) -> DataFrame:
    return drift.column_shift(batch_rows(spark, sf_dir), FEATURES, 5.0, by=["batch"],
                              where=F.col("batch") == SHIFT_BATCH)


def q_ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = reference_rows(spark, sf_dir).select(F.col("event_type").alias("feature"), "value")
    bat = batch_rows(spark, sf_dir).select("batch", F.col("event_type").alias("feature"), "value")
    return rounded(drift.ks_drift(ref, bat))


def _monitor_ks(spark, sf_dir):
    ref = drift.to_long(reference_rows(spark, sf_dir), FEATURES)
    bat = drift.to_long(shifted_batches(spark, sf_dir), FEATURES, keep=["batch"])
    return drift.ks_drift(ref, bat)


def q_inject_drift(spark, sf_dir):
    out = shifted_batches(spark, sf_dir).select("event_id", "batch", *FEATURES)
    return rounded(out)


def q_drift_summary(spark, sf_dir):
    return rounded(drift.drift_summary(_monitor_ks(spark, sf_dir)))


def _quality(spark, sf_dir):
    b = shifted_batches(spark, sf_dir).withColumns({
        "y": (F.col("event_type") == "purchase").cast("int"),
        "p": F.coalesce(F.col("value") > 100, F.lit(False)).cast("int")})
    return drift.batch_quality(b, "y", "p")


def _monitor_batches(spark, sf_dir):
    return drift.monitor_batches(_quality(spark, sf_dir), drift.drift_summary(_monitor_ks(spark, sf_dir)))


def q_monitor_batches(spark, sf_dir):
    return rounded(_monitor_batches(spark, sf_dir))


def q_monitor_summary(spark, sf_dir):
    mb = _monitor_batches(spark, sf_dir)  # rounded before averaging, as the report table is
    return rounded(drift.monitor_summary(rounded(mb)))


QUERIES = {
    "ks_drift": q_ks_drift,
    "inject_drift": q_inject_drift,
    "drift_summary": q_drift_summary,
    "monitor_batches": q_monitor_batches,
    "monitor_summary": q_monitor_summary,
}

# ---------------------------------------------------------------- oracle SQL


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    lam = f"({d} * sqrt(CAST({n} AS DOUBLE) * CAST({m} AS DOUBLE) / (CAST({n} AS DOUBLE) + CAST({m} AS DOUBLE))))"
    alt = (f"list_sum(list_transform(range(1, {TERMS + 1}), lambda k: "
           f"(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * CAST(k * k AS DOUBLE) * {lam} * {lam})))")
    theta = (f"list_sum(list_transform(range(1, {TERMS + 1}), lambda k: "
             f"exp(-CAST((2 * k - 1) * (2 * k - 1) AS DOUBLE) * {math.pi ** 2!r} / (8.0 * {lam} * {lam}))))")
    q = (f"CASE WHEN {lam} IS NULL THEN NULL WHEN {lam} <= 0 THEN 1.0 "
         f"WHEN {lam} >= {SWITCH} THEN 2.0 * {alt} "
         f"ELSE 1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * {theta} END")
    return f"least(greatest({q}, 0.0), 1.0)"


EVENTS_CTE = f"""
ev AS (SELECT event_id, ts, event_type, value,
              TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              CAST(user_id AS DOUBLE) AS user_id FROM events),
ref_rows AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{CUTOFF}'),
later AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{CUTOFF}'),
bsize AS (SELECT count(*) // {N_BATCHES} AS size FROM later),
batched AS (SELECT l.*, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1)
                   / (SELECT size FROM bsize)) + 1 AS INTEGER) AS batch FROM later l),
bat_rows AS (SELECT * FROM batched WHERE batch <= {N_BATCHES}),
sds AS (SELECT batch, stddev_samp(value) AS sd_value, stddev_samp(k) AS sd_k,
               stddev_samp(user_id) AS sd_user_id FROM bat_rows WHERE batch = {SHIFT_BATCH} GROUP BY batch),
shifted AS (SELECT b.event_id, b.ts, b.event_type, b.batch,
    CASE WHEN s.sd_value > 0 THEN b.value + 5.0 * s.sd_value ELSE b.value END AS value,
    CASE WHEN s.sd_k > 0 THEN b.k + 5.0 * s.sd_k ELSE b.k END AS k,
    CASE WHEN s.sd_user_id > 0 THEN b.user_id + 5.0 * s.sd_user_id ELSE b.user_id END AS user_id
  FROM bat_rows b LEFT JOIN sds s ON b.batch = s.batch)
"""


def ks_sql(ref_long: str, bat_long: str) -> str:
    """KS per (batch, feature) from two long CTE names (feature, value) / (batch, feature, value)."""
    return f"""
rc AS (SELECT feature, value, count(*) AS c FROM {ref_long}
       WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature, value),
bc AS (SELECT batch, feature, value, count(*) AS c FROM {bat_long}
       WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY batch, feature, value),
nr AS (SELECT feature, CAST(sum(c) AS BIGINT) AS n_ref FROM rc GROUP BY feature),
nb AS (SELECT batch, feature, CAST(sum(c) AS BIGINT) AS n_batch FROM bc GROUP BY batch, feature),
pairs AS (SELECT nb.batch, nb.feature, nr.n_ref, nb.n_batch FROM nb JOIN nr ON nb.feature = nr.feature),
merged AS (SELECT batch, feature, value, sum(cr) AS cr, sum(cb) AS cb FROM (
    SELECT p.batch, rc.feature, rc.value, rc.c AS cr, 0 AS cb FROM rc JOIN pairs p ON rc.feature = p.feature
    UNION ALL
    SELECT bc.batch, bc.feature, bc.value, 0 AS cr, bc.c AS cb FROM bc
      JOIN pairs p ON bc.batch = p.batch AND bc.feature = p.feature) u
  GROUP BY batch, feature, value),
cum AS (SELECT batch, feature, value,
    sum(cr) OVER (PARTITION BY batch, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum_ref,
    sum(cb) OVER (PARTITION BY batch, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum_bat
  FROM merged),
dstat AS (SELECT c.batch, c.feature, p.n_ref, p.n_batch,
    max(abs(CAST(cum_ref AS DOUBLE) / p.n_ref - CAST(cum_bat AS DOUBLE) / p.n_batch)) AS statistic
  FROM cum c JOIN pairs p ON c.batch = p.batch AND c.feature = p.feature
  GROUP BY c.batch, c.feature, p.n_ref, p.n_batch),
ks AS (SELECT batch, feature, n_ref, n_batch, statistic,
    {ks_pvalue_sql('statistic', 'n_ref', 'n_batch')} AS p_value FROM dstat)
"""


_LONG = """
ref_long AS (SELECT 'value' AS feature, value FROM ref_rows UNION ALL SELECT 'k', k FROM ref_rows
             UNION ALL SELECT 'user_id', user_id FROM ref_rows),
bat_long AS (SELECT batch, 'value' AS feature, value FROM shifted UNION ALL SELECT batch, 'k', k FROM shifted
             UNION ALL SELECT batch, 'user_id', user_id FROM shifted),
"""

_SUMMARY = """
summ AS (SELECT batch, CAST(count_if(p_value < 0.05) AS BIGINT) AS n_features_drifted,
                CAST(count(*) AS BIGINT) AS total_features,
                CAST(count_if(p_value < 0.05) AS DOUBLE) / count(*) AS drift_percentage
         FROM ks GROUP BY batch),
qual AS (SELECT batch,
    CAST(count_if(y = 1 AND p = 1) AS BIGINT) AS tp, CAST(count_if(y = 0 AND p = 1) AS BIGINT) AS fp,
    CAST(count_if(y = 0 AND p = 0) AS BIGINT) AS tn, CAST(count_if(y = 1 AND p = 0) AS BIGINT) AS fn
  FROM (SELECT batch, CAST(event_type = 'purchase' AS INTEGER) AS y,
               CAST(coalesce(value > 100, false) AS INTEGER) AS p FROM shifted) GROUP BY batch),
qm AS (SELECT batch, tp, fp, tn, fn,
    coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0) AS f1_score,
    coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + tn + fn, 0), 0) AS accuracy,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
    coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
      / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc
  FROM qual),
mb AS (SELECT coalesce(q.batch, s.batch) AS batch, q.tp, q.fp, q.tn, q.fn, q.f1_score, q.accuracy,
    q.precision, q.recall, q.mcc, s.n_features_drifted, s.total_features, s.drift_percentage,
    s.drift_percentage > 0.25 AS dataset_drift,
    CASE WHEN s.drift_percentage > 0.25 THEN 'DRIFT' ELSE 'STABLE' END AS status
  FROM qm q FULL JOIN summ s ON q.batch = s.batch)
"""

ORACLE = {
    "ks_drift": "WITH " + EVENTS_CTE + """,
ref_long AS (SELECT event_type AS feature, value FROM ref_rows),
bat_long AS (SELECT batch, event_type AS feature, value FROM bat_rows),
""" + ks_sql("ref_long", "bat_long") + """
SELECT batch, feature, n_ref, n_batch, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
       p_value < 0.05 AS drifted FROM ks""",
    "inject_drift": "WITH " + EVENTS_CTE + """
SELECT event_id, batch, round(value, 6) AS value, round(k, 6) AS k, round(user_id, 6) AS user_id FROM shifted""",
    "drift_summary": "WITH " + EVENTS_CTE + "," + _LONG + ks_sql("ref_long", "bat_long") + "," + _SUMMARY + """
SELECT batch, n_features_drifted, total_features, round(drift_percentage, 6) AS drift_percentage,
       drift_percentage > 0.25 AS dataset_drift FROM summ""",
    "monitor_batches": "WITH " + EVENTS_CTE + "," + _LONG + ks_sql("ref_long", "bat_long") + "," + _SUMMARY + """
SELECT batch, tp, fp, tn, fn, round(f1_score, 6) AS f1_score, round(accuracy, 6) AS accuracy,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(mcc, 6) AS mcc,
  n_features_drifted, total_features, round(drift_percentage, 6) AS drift_percentage, dataset_drift, status
FROM mb""",
    "monitor_summary": "WITH " + EVENTS_CTE + "," + _LONG + ks_sql("ref_long", "bat_long") + "," + _SUMMARY + """,
mbr AS (SELECT dataset_drift, round(f1_score, 6) AS f1_score, round(accuracy, 6) AS accuracy FROM mb)
SELECT CAST(count(*) AS BIGINT) AS n_batches, CAST(count_if(coalesce(dataset_drift, false)) AS BIGINT) AS n_drift_batches,
  CAST(round(avg(CAST(f1_score AS DECIMAL(38, 18))) FILTER (WHERE NOT coalesce(dataset_drift, false)), 6) AS DOUBLE)
    AS stable_mean_f1,
  CAST(round(avg(CAST(accuracy AS DECIMAL(38, 18))) FILTER (WHERE NOT coalesce(dataset_drift, false)), 6) AS DOUBLE)
    AS stable_mean_accuracy
FROM mbr""",
}
