"""Bindings of the sources and sinks: CSV scan with declared schema and optional
sources, split write partitioned by split with pruned read-back, JSON reports."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import drift
from tessera.operators.sampling import stratified_split
from tessera.plans import monitoring as MON
from tessera.plans import statistics as ST
from tessera.plans.common import rounded, table
from tessera.sources.tables import nested_report, read_csv_sources, read_report, read_split, to_json_report, write_report, write_splits
from tessera.streaming.monitor import scratch_path

CUSTOMER_CSV_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def q_csv_scan(spark, sf):
    folder = scratch_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(os.path.join(folder, "customer"))
    found = read_csv_sources(spark, {
        "customer": (os.path.join(folder, "customer"), CUSTOMER_CSV_SCHEMA),
        "missing": (os.path.join(folder, "not_there"), CUSTOMER_CSV_SCHEMA)})
    c = found["customer"]
    return rounded(c.where(F.col("c_acctbal") > 0).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))


def q_write_roundtrip(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    split = stratified_split(c, "c_custkey", "c_mktsegment", ST.TEST, ST.VAL, ST.SEED)
    folder = scratch_path(spark, "splits")
    write_splits(split, folder)
    return read_split(spark, folder, "train").select("c_custkey", "c_mktsegment", "split")


def q_report_json(spark, sf):
    ks = MON._monitor_ks(spark, sf)
    summ = drift.drift_summary(ks)
    rep = to_json_report(rounded(ks), ["batch"], "feature", ["statistic", "p_value", "drifted"])
    return rep.join(rounded(summ), on="batch")


def q_json_sink(spark, sf):
    """The nested drift report of every batch, written as JSON, read back and taken apart again."""
    report = nested_report(rounded(MON._monitor_ks(spark, sf)), ["batch"], "feature", ["n_ref", "n_batch", "statistic", "p_value", "drifted"])
    path = scratch_path(spark, "report-json")
    write_report(report, path, "json")
    back = read_report(spark, path, report.schema, "json")
    return back.select("batch", F.explode("feature_results").alias("feature", "r")).select("batch", "feature", "r.*")


def q_csv_sink(spark, sf):
    """The monitoring table, written as CSV and read back with its schema."""
    report = MON.q_monitor_batches(spark, sf)
    path = scratch_path(spark, "report-csv")
    write_report(report, path, "csv")
    return read_report(spark, path, report.schema, "csv")


QUERIES = {
    "json_sink": q_json_sink,
    "csv_sink": q_csv_sink,
    "csv_scan": q_csv_scan,
    "write_roundtrip": q_write_roundtrip,
    "report_json": q_report_json,
}

ORACLE = {
    "json_sink": "WITH " + MON.EVENTS_CTE + "," + MON._LONG + MON.ks_sql("ref_long", "bat_long") + """
SELECT batch, feature, n_ref, n_batch, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM ks""",
    "csv_sink": MON.ORACLE["monitor_batches"],
    "csv_scan": """SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer
        WHERE c_acctbal > 0""",
    "write_roundtrip": "WITH " + ST.SPLIT + "SELECT c_custkey, c_mktsegment, split FROM sp WHERE split = 'train'",
}
