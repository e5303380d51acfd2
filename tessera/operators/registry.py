"""Run log and model registry as plain tables.

* runs are long tables ``params(run_id, key, value)`` and
  ``metrics(run_id, key, value)``, appended per run;
* model stages are an append-only event table
  ``(model, version, stage, seq...)``; the current state is derived;
* registrations are data folders named by numbered commit files, each created only if
  absent: writers at one time get different versions.

"Best" and "latest" are grouped max-by aggregates (partial aggregation per
partition), never a sort of the whole log; numbering uses the range-cut
prefix, so a model with a third of all events is still split.  Ids may be of any
orderable type, text included.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import prefix

PRODUCTION, STAGING, ARCHIVED = "Production", "Staging", "Archived"


def log_params(runs: DataFrame, run_id: str, params: list[str], max_chars: int | None = None) -> DataFrame:
    """(run_id, key, value): one row per parameter, values whole (or cut to ``max_chars``)."""
    casted = runs.select(run_id, *[F.col(p).cast("string").alias(p) for p in params])
    long = casted.unpivot([run_id], params, "key", "value")
    return long if max_chars is None else long.withColumn("value", F.substring("value", 1, max_chars))


def log_metrics(runs: DataFrame, run_id: str, metrics: list[str]) -> DataFrame:
    casted = runs.select(run_id, *[F.col(m).cast("double").alias(m) for m in metrics])
    return casted.unpivot([run_id], metrics, "key", "value")


def running_best(trials: DataFrame, order: list[str], metric: str, by: list[str] | None = None,
                 name: str = "best_so_far", higher_is_better: bool = True) -> DataFrame:
    """Best metric so far in trial order (running max, or min)."""
    return prefix.running(trials, by or [], order, {name: F.col(metric)},
                          how="max" if higher_is_better else "min")


def best_by(df: DataFrame, by: list[str], rank: list, payload: list[str]) -> DataFrame:
    """One row per ``by`` group: the ``payload`` of the row with the smallest ``rank`` tuple.

    A grouped min over a struct: partial aggregation, no sort, no window.
    """
    order = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)])
    best = df.groupBy(*by).agg(F.min_by(F.struct(*payload), order).alias("__b"))
    return best.select(*by, *[F.col(f"__b.{p}").alias(p) for p in payload])


def _highest(metric: str) -> list:
    """Rank columns of the highest metric; missing ones (null, NaN) last."""
    m = F.col(metric)
    return [m.isNull() | F.isnan(m.cast("double")), -m]


def best_run(runs: DataFrame, experiment: str, run_id: str, metric: str,
             parent: str | None = None) -> DataFrame:
    """Top-level run with the highest metric per experiment (missing metric last, then lowest id)."""
    top = runs if parent is None else runs.where(F.col(parent).isNull())
    return best_by(top, [experiment], [*_highest(metric), F.col(run_id)], [run_id, metric])


def best_run_fallback(runs: DataFrame, experiment: str, run_id: str, metric: str,
                      preferred, parent: str | None = None) -> DataFrame:
    """Prefer runs matching ``preferred`` (e.g. a model type); fall back to any top-level run."""
    top = runs if parent is None else runs.where(F.col(parent).isNull())
    ranked = top.withColumn("preferred", F.coalesce(preferred, F.lit(False)))
    return best_by(ranked, [experiment], [~F.col("preferred"), *_highest(metric), F.col(run_id)],
                   [run_id, metric, "preferred"])


def production_else_best(stages: DataFrame, runs: DataFrame, experiment: str, run_id: str, metric: str,
                         stage: str = "stage", parent: str | None = None) -> DataFrame:
    """The run to monitor per experiment: the one in Production in ``stages`` (experiment, run_id,
    stage), else the best run.  Of several in Production the lowest id counts."""
    live = (stages.where(F.col(stage) == PRODUCTION).groupBy(experiment).agg(F.min(run_id).alias("__live")))
    best = best_run(runs, experiment, run_id, metric, parent).select(experiment, F.col(run_id).alias("__best"))
    both = best.join(live, on=experiment, how="full")
    return both.select(experiment, F.coalesce("__live", "__best").alias(run_id), F.col("__live").isNotNull().alias("in_production"))


def append_runs(path: str, runs: DataFrame, run_id: str, params: list[str], metrics: list[str],
                tags: dict[str, str] | None = None, parent: str | None = None) -> None:
    """Append runs to the long tables ``params``, ``metrics`` and ``tags`` (run_id, key, value) below
    ``path``; the parent run is kept as the tag ``parent``."""
    log_params(runs, run_id, params).write.mode("append").parquet(f"{path}/params")
    log_metrics(runs, run_id, metrics).write.mode("append").parquet(f"{path}/metrics")
    kept = {k: F.lit(v) for k, v in (tags or {}).items()} | ({"parent": F.col(parent).cast("string")} if parent else {})
    if kept:
        wide = runs.select(run_id, *[v.alias(f"__t{i}") for i, v in enumerate(kept.values())])
        names = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"__t{i}").alias("value")) for i, k in enumerate(kept)])
        long = wide.select(run_id, F.inline(names)).where(F.col("value").isNotNull())
        long.write.mode("append").parquet(f"{path}/tags")


def best_trial(trials: DataFrame, by: list[str], trial_id: str, loss: str) -> DataFrame:
    """Trial with the lowest loss per group (missing losses last, then lowest id)."""
    v = F.col(loss)
    return best_by(trials, by, [v.isNull() | F.isnan(v.cast("double")), v, F.col(trial_id)], [trial_id, loss])


def version_numbers(registrations: DataFrame, model: str, order: list[str],
                    name: str = "version") -> DataFrame:
    """Version 1, 2, ... per model in registration order (next = max + 1)."""
    return prefix.row_number(registrations, [model], order, name=name)


def current_stage(events: DataFrame, model: str, version: str, stage: str, order: list[str]) -> DataFrame:
    """Current stage per (model, version): the last event's stage, where of several versions in
    Production only the last promoted one stays and the others read Archived."""
    last = events.groupBy(model, version).agg(F.max(F.struct(*order, F.col(stage).alias("__stage"))).alias("__e"))
    live = F.col("__e.__stage") == PRODUCTION
    newest = last.where(live).groupBy(model).agg(F.max_by(F.col(version), F.col("__e")).alias("__live"))
    newest = newest.withColumnRenamed(model, "__model")
    out = last.join(newest, F.col(model).eqNullSafe(F.col("__model")), "left")
    st = F.when(live & ~F.col(version).eqNullSafe(F.col("__live")), F.lit(ARCHIVED)).otherwise(F.col("__e.__stage"))
    return out.select(model, version, st.alias(stage))


def next_version(registry: DataFrame, model: str, version: str = "version",
                 candidates: DataFrame | None = None) -> DataFrame:
    """Version number a new registration of each model gets: max(version) + 1 (1 for new models).
    ``candidates`` (one row per model to register) may name models not yet in the registry."""
    latest = registry.groupBy(model).agg(F.max(version).alias("__v"))
    base = candidates.select(model).distinct() if candidates is not None else latest.select(model)
    out = base.join(latest, on=model, how="left")
    return out.select(model, (F.coalesce(F.col("__v"), F.lit(0)) + 1).alias("next_version"))


def promote_latest(events: DataFrame, model: str, version: str, stage: str, seq: str) -> DataFrame:
    """Append-only promotion: for each model's newest version, a Staging then a
    Production event after the last sequence number.  ``current_stage`` then
    reads the other Production versions as Archived."""
    latest = events.groupBy(model).agg(F.max(version).alias(version), F.max(seq).alias("__last"))
    steps = latest.select(model, version, F.explode(F.array(
        F.struct(F.lit(STAGING).alias("s"), F.lit(1).alias("o")),
        F.struct(F.lit(PRODUCTION).alias("s"), F.lit(2).alias("o")))).alias("__e"), "__last")
    new = steps.select(model, version, F.col("__e.s").alias(stage),
                       (F.col("__last") + F.col("__e.o")).alias(seq))
    return events.select(model, version, stage, seq).unionByName(new)


def _create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text`` unless it exists; of several writers only one succeeds."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.getParent())
    if fs.getUri().getScheme() == "file":  # its create isn't exclusive: a hard link is
        target = hadoop.toUri().getPath()
        part = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}"
        with open(part, "w") as out:
            out.write(text)
        try:
            os.link(part, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    try:
        out = fs.create(hadoop, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, data folder) of the commits below ``path``, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    rows = spark.read.text(f"{path}/commits", wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value").collect()  # one a commit
    return sorted((int(r["name"]), r["value"]) for r in rows if r["name"].isdigit())


def register(path: str, rows: DataFrame, model: str) -> DataFrame:
    """Add the registrations ``rows`` (one a new model version) to the table at ``path``; they with their versions.

    The rows are written first, then a commit file with the next number is created only if it is absent;
    a writer that finds the number taken tries the next one.  Versions follow from the commits' order, so two
    writers never get one version, and rows whose writer failed before its commit don't exist.
    """
    spark = rows.sparkSession
    folder = uuid.uuid4().hex
    rows.write.parquet(f"{path}/data/{folder}")
    number = (commits(spark, path) or [(0, "")])[-1][0] + 1
    while not _create_if_absent(spark, f"{path}/commits/{number:010d}", folder):
        number += 1
    return registrations(spark, path, model).filter(F.col("commit") == number)


def registrations(spark: SparkSession, path: str, model: str) -> DataFrame:
    """All committed registrations with ``commit`` and ``version`` (1, 2, ... per model by commit)."""
    held = commits(spark, path)
    if not held:
        raise FileNotFoundError(f"no registration was committed below {path}")
    numbers = spark.createDataFrame([(n, f) for n, f in held], "commit long, __folder string")
    rows = spark.read.parquet(*[f"{path}/data/{f}" for _, f in held]).withColumn("__folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    rows = rows.join(F.broadcast(numbers), "__folder").drop("__folder")  # one row a commit
    rest = F.sha2(F.to_json(F.struct(*[c for c in rows.columns])), 256)  # several rows of one commit: by content
    return version_numbers(rows.withColumn("__rest", rest), model, ["commit", "__rest"]).drop("__rest")
