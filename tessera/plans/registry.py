"""Bindings of the run log / registry operators: ``orders`` read as an event log.

model = o_custkey, event order = (o_orderdate, o_orderkey), experiment =
o_orderpriority, run = o_orderkey, metric = o_totalprice, stage from
o_orderstatus, version from the priority digit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import registry as R
from tessera.plans.common import rounded, table

# fixed values of the binding
STAGE_OF_STATUS = {"F": "Production", "O": "Staging", "P": "Archived"}
NO_METRIC_EXPERIMENT = "5-LOW"


def _orders(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 "o_orderdate", "o_orderpriority")


def _runs(spark, sf):
    o = _orders(spark, sf)
    return o.select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"), F.col("o_orderpriority").alias("experiment"),
        F.when(F.col("o_orderpriority") != NO_METRIC_EXPERIMENT, F.col("o_totalprice")).alias("metric"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("parent_id"),
        F.col("o_orderstatus").alias("model_type"))


def q_run_log_append(spark, sf):
    o = _orders(spark, sf).withColumn("note", F.repeat(F.col("o_orderpriority"), 30))
    return R.log_params(o, "o_orderkey", ["o_orderpriority", "o_orderstatus", "note"])


def q_running_best(spark, sf):
    o = _orders(spark, sf)
    out = R.running_best(o, ["o_orderdate", "o_orderkey"], "o_totalprice", by=["o_custkey"])
    return rounded(out.select("o_orderkey", "o_custkey", "best_so_far"))


def q_best_trial(spark, sf):
    o = _orders(spark, sf).withColumn("loss", F.lit(1.0) / F.col("o_totalprice"))
    return rounded(R.best_trial(o, ["o_orderpriority"], "o_orderkey", "loss"))


def q_best_run(spark, sf):
    return rounded(R.best_run(_runs(spark, sf), "experiment", "run_id", "metric", parent="parent_id"))


def q_best_run_fallback(spark, sf):
    runs = _runs(spark, sf)
    return rounded(R.best_run_fallback(runs, "experiment", "run_id", "metric",
                                       preferred=F.col("model_type") == "F", parent="parent_id"))


def q_version_history(spark, sf):
    o = _orders(spark, sf).select(F.col("o_custkey").alias("model"), F.col("o_orderkey").alias("run_id"),
                                  "o_orderdate")
    return R.version_numbers(o, "model", ["o_orderdate", "run_id"]).select("model", "version", "run_id")


def q_current_stage(spark, sf):
    o = _orders(spark, sf)
    stage = F.create_map(*[F.lit(x) for kv in STAGE_OF_STATUS.items() for x in kv])[F.col("o_orderstatus")]
    ev = o.select(F.col("o_custkey").alias("model"),
                  F.substring("o_orderpriority", 1, 1).cast("int").alias("version"),
                  stage.alias("stage"), "o_orderdate", "o_orderkey")
    return R.current_stage(ev, "model", "version", "stage", ["o_orderdate", "o_orderkey"])


def q_production_else_best(spark, sf):
    runs = _runs(spark, sf)
    o = _orders(spark, sf)
    stages = o.where("o_orderpriority in ('1-URGENT', '3-MEDIUM') and o_custkey % 2 = 0").select(
        F.col("o_orderpriority").alias("experiment"), F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", "Production").otherwise("Staging").alias("stage"))
    return R.production_else_best(stages, runs, "experiment", "run_id", "metric", parent="parent_id")


QUERIES = {
    "production_else_best": q_production_else_best,
    "run_log_append": q_run_log_append,
    "running_best": q_running_best,
    "best_trial": q_best_trial,
    "best_run": q_best_run,
    "best_run_fallback": q_best_run_fallback,
    "version_history": q_version_history,
    "current_stage": q_current_stage,
}

RUNS = f"""
runs AS (SELECT 'run-' || o_orderkey AS run_id, o_orderpriority AS experiment,
    CASE WHEN o_orderpriority <> '{NO_METRIC_EXPERIMENT}' THEN o_totalprice END AS metric,
    CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS parent_id, o_orderstatus AS model_type FROM orders)
"""

ORACLE = {
    "production_else_best": "WITH " + RUNS + """,
best AS (SELECT experiment, run_id FROM (SELECT *, row_number() OVER (PARTITION BY experiment
    ORDER BY metric DESC NULLS LAST, run_id) AS rn FROM runs WHERE parent_id IS NULL) WHERE rn = 1),
live AS (SELECT o_orderpriority AS experiment, min('run-' || o_orderkey) AS run_id FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_custkey % 2 = 0 AND o_orderstatus = 'F' GROUP BY 1)
SELECT coalesce(b.experiment, l.experiment) AS experiment, coalesce(l.run_id, b.run_id) AS run_id,
       l.run_id IS NOT NULL AS in_production FROM best b FULL JOIN live l ON b.experiment = l.experiment""",
    "run_log_append": """SELECT o_orderkey, key, value FROM (
    SELECT o_orderkey, 'o_orderpriority' AS key, o_orderpriority AS value FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 'note', repeat(o_orderpriority, 30) FROM orders)""",
    "running_best": """SELECT o_orderkey, o_custkey, round(max(o_totalprice) OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 6) AS best_so_far FROM orders""",
    "best_trial": """SELECT o_orderpriority, o_orderkey, round(loss, 6) AS loss FROM (
    SELECT o_orderpriority, o_orderkey, 1.0 / o_totalprice AS loss,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY 1.0 / o_totalprice, o_orderkey) AS rn FROM orders)
  WHERE rn = 1""",
    "best_run": "WITH " + RUNS + """
SELECT experiment, run_id, round(metric, 6) AS metric FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY metric DESC NULLS LAST, run_id) AS rn
  FROM runs WHERE parent_id IS NULL) WHERE rn = 1""",
    "best_run_fallback": "WITH " + RUNS + """
SELECT experiment, run_id, round(metric, 6) AS metric, preferred FROM (
  SELECT *, coalesce(model_type = 'F', false) AS preferred,
    row_number() OVER (PARTITION BY experiment ORDER BY coalesce(model_type = 'F', false) DESC,
                       metric DESC NULLS LAST, run_id) AS rn
  FROM runs WHERE parent_id IS NULL) WHERE rn = 1""",
    "version_history": """SELECT o_custkey AS model, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey) AS version, o_orderkey AS run_id FROM orders""",
    "current_stage": """WITH ev AS (SELECT o_custkey AS model, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS version,
    CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' WHEN 'P' THEN 'Archived' END AS stage,
    o_orderdate, o_orderkey FROM orders),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, version
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM ev) WHERE rn = 1),
newest AS (SELECT model, version AS pv FROM (SELECT *, row_number() OVER (PARTITION BY model
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS pn FROM last WHERE stage = 'Production') WHERE pn = 1)
SELECT l.model, l.version, CASE WHEN l.stage = 'Production' AND l.version <> n.pv THEN 'Archived' ELSE l.stage END AS stage
FROM last l LEFT JOIN newest n ON l.model = n.model""",
}
