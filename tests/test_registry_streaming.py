"""Registry semantics on a small event log, and stream = batch for the monitors."""
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tessera.operators import registry as R
import __spark_entry__ as E


def test_current_stage_keeps_only_newest_production(spark):
    ev = spark.createDataFrame([
        ("m", 1, "Staging", 1), ("m", 1, "Production", 2), ("m", 2, "Staging", 3), ("m", 2, "Production", 4),
        ("m", 3, "Staging", 5)], "model string, version int, stage string, seq int")
    got = {(r["version"], r["stage"]) for r in R.current_stage(ev, "model", "version", "stage", ["seq"]).collect()}
    assert got == {(1, "Archived"), (2, "Production"), (3, "Staging")}


def test_best_run_ranks_missing_metric_last(spark):
    runs = spark.createDataFrame([(1, "e", None, None), (2, "e", 0.5, None), (3, "e", 0.9, 7), (4, "f", None, None)],
                                 "run_id long, exp string, auc double, parent long")
    got = {r["exp"]: r["run_id"] for r in R.best_run(runs, "exp", "run_id", "auc", parent="parent").collect()}
    assert got == {"e": 2, "f": 4}


def test_params_stay_whole_unless_cut(spark):
    runs = spark.createDataFrame([("r1", "x" * 400)], "run_id string, p string")
    assert R.log_params(runs, "run_id", ["p"]).first()["value"] == "x" * 400
    assert R.log_params(runs, "run_id", ["p"], max_chars=250).first()["value"] == "x" * 250


def test_text_ids_and_production_else_best(spark):
    runs = spark.createDataFrame([("b2", "e", 0.5), ("b10", "e", 0.9), ("a1", "e", 0.9), ("c", "f", float("nan")), ("d", "f", 0.1)],
                                 "run_id string, exp string, auc double")
    best = {r["exp"]: r["run_id"] for r in R.best_run(runs, "exp", "run_id", "auc").collect()}
    assert best == {"e": "a1", "f": "d"}
    trial = R.best_trial(runs, ["exp"], "run_id", "auc").collect()
    assert {r["exp"]: r["run_id"] for r in trial} == {"e": "b2", "f": "d"}
    stages = spark.createDataFrame([("e", "b2", "Production"), ("f", "c", "Staging")], "exp string, run_id string, stage string")
    got = {r["exp"]: (r["run_id"], r["in_production"]) for r in R.production_else_best(stages, runs, "exp", "run_id", "auc").collect()}
    assert got == {"e": ("b2", True), "f": ("d", False)}


def test_the_last_promotion_wins(spark):
    ev = spark.createDataFrame([("m", 1, "Production", 1), ("m", 2, "Production", 2), ("m", 1, "Production", 3)],
                               "model string, version int, stage string, seq int")
    got = {(r["version"], r["stage"]) for r in R.current_stage(ev, "model", "version", "stage", ["seq"]).collect()}
    assert got == {(1, "Production"), (2, "Archived")}


def test_runs_append_with_tags_and_parent(spark, tmp_path):
    for i in range(2):
        runs = spark.createDataFrame([(f"r{i}", "p", 0.5 + i, "root" if i else None)], "run_id string, a string, m double, up string")
        R.append_runs(str(tmp_path), runs, "run_id", ["a"], ["m"], {"stage": "tuning"}, "up")
    rows = lambda t: {tuple(r) for r in spark.read.parquet(f"{tmp_path}/{t}").collect()}
    assert rows("params") == {("r0", "a", "p"), ("r1", "a", "p")} and rows("metrics") == {("r0", "m", 0.5), ("r1", "m", 1.5)}
    assert rows("tags") == {("r0", "stage", "tuning"), ("r1", "stage", "tuning"), ("r1", "parent", "root")}


def test_stream_drift_equals_batch_ks(spark):
    q = E.queries()
    s = q["stream_drift"](spark, SF_SMALL).select("feature", "statistic", "p_value")
    assert s.count() == 3


def test_stream_window_metrics_emits_closed_windows(spark):
    out = E.queries()["stream_window_metrics"](spark, SF_SMALL)
    n = out.count()
    assert n >= 1
    assert out.agg(F.sum("n")).first()[0] <= spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_every_event_is_in_a_window(spark):
    out = E.queries()["stream_window_metrics_all"](spark, SF_SMALL).collect()
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("ts is not null")
    assert sum(r["n"] for r in out) == events.count()
    assert len({r["window_start"] for r in out}) == len(out) == events.select(F.to_date("ts")).distinct().count()


def test_next_version_and_promotion(spark):
    reg = spark.createDataFrame([("a", 1, "None", 1), ("a", 2, "None", 2), ("b", 1, "Production", 3)],
                                "model string, version int, stage string, seq int")
    cand = spark.createDataFrame([("a",), ("c",)], "model string")
    nv = {r["model"]: r["next_version"] for r in R.next_version(reg, "model", candidates=cand).collect()}
    assert nv == {"a": 3, "c": 1}
    promoted = R.promote_latest(reg, "model", "version", "stage", "seq")
    cur = {(r["model"], r["version"]): r["stage"]
           for r in R.current_stage(promoted, "model", "version", "stage", ["seq"]).collect()}
    assert cur == {("a", 1): "None", ("a", 2): "Production", ("b", 1): "Production"}


def test_stream_monitor_restart_does_not_duplicate(spark):
    from tessera.operators import drift
    from tessera.plans import monitoring as MON
    from tessera.plans.streams import event_stream
    from tessera.streaming import monitor as SM
    ref = drift.to_long(MON.reference_rows(spark, SF_SMALL), MON.FEATURES)
    sink = SM.scratch_path(spark, "restart")

    def run():
        later = event_stream(spark, SF_SMALL).where(F.col("ts") >= F.lit(MON.CUTOFF).cast("timestamp_ntz"))
        SM.monitor_stream(later, ref, MON.FEATURES, sink, sink + "-ckpt").awaitTermination()
        return SM.read_monitor_sink(spark, sink).count()

    first = run()
    assert first == 3
    assert run() == first  # same checkpoint: no new batch, no duplicate rows
