"""Data-drift detection: two-sample KS per (batch, feature), dataset verdicts,
column-shift what-if, and per-batch quality joined with drift.

Inputs are *long* tables: ``reference(feature, value)`` and
``batches(batch, feature, value)``.  ``to_long`` turns a wide table into one.
The KS statistic is computed on distinct values with counts (map-side
combined), so the unpivot never multiplies the shuffle by the feature count
with raw rows, and running sums use the range-cut prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.kolmogorov import ks_pvalue, ks_pvalue_exact
from tessera.operators import prefix
from tessera.operators.metrics import binary_metrics_from_counts, confusion_counts


def to_long(df: DataFrame, features: list[str], keep: list[str] | None = None,
            feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot ``features`` into (``keep``..., feature, value) with double values."""
    keep = keep or []
    casted = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return casted.unpivot(keep, features, feature_col, value_col)


def value_counts(long: DataFrame, feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """(feature, value, c_ref): a reference in the form that ``ks_drift`` can use again and again."""
    v = F.col(value_col)
    return (long.where(v.isNotNull() & ~F.isnan(v)).groupBy(feature_col, value_col)
            .agg(F.count(F.lit(1)).alias("c_ref")))


def ks_drift(reference: DataFrame, batches: DataFrame, alpha: float = 0.05,
             feature_col: str = "feature", value_col: str = "value",
             batch_col: str = "batch", buckets: int | None = None, exact: bool = False) -> DataFrame:
    """Per (batch, feature): n_ref, n_batch, statistic D, p_value, drifted (p < alpha).

    The p-value is that of the limit distribution; with ``exact`` that of the samples' sizes, where
    both hold ``kolmogorov.EXACT_SIZE`` values at most.

    Only features present on both sides are tested; nulls and NaN are dropped.  ``reference`` may
    hold values or their counts (``value_counts``), and so may ``batches`` (a column ``c_bat``).
    """
    def clean(df):
        v = F.col(value_col)
        return df.where(v.isNotNull() & ~F.isnan(v))

    ref = reference if "c_ref" in reference.columns else value_counts(clean(reference), feature_col, value_col)
    bat = clean(batches).groupBy(batch_col, feature_col, value_col).agg(
        (F.sum("c_bat") if "c_bat" in batches.columns else F.count(F.lit(1))).alias("c_bat"))
    # the reference counts are compared with every batch that has the feature
    batch_feats = bat.select(batch_col, feature_col).distinct()
    ref_per_batch = (ref.join(batch_feats, on=feature_col)
                     .select(batch_col, feature_col, value_col, "c_ref",
                             F.lit(0).cast("long").alias("c_bat")))
    merged = (ref_per_batch.unionByName(bat.select(batch_col, feature_col, value_col,
                                                   F.lit(0).cast("long").alias("c_ref"), "c_bat"))
              .groupBy(batch_col, feature_col, value_col)
              .agg(F.sum("c_ref").alias("c_ref"), F.sum("c_bat").alias("c_bat")))
    cum = prefix.running(merged, [batch_col, feature_col], [value_col],
                         {"cum_ref": F.col("c_ref"), "cum_bat": F.col("c_bat")},
                         buckets=buckets, totals=True)
    gap = F.abs(F.col("cum_ref") / F.col("cum_ref_total") - F.col("cum_bat") / F.col("cum_bat_total"))
    stat = (cum.where((F.col("cum_ref_total") > 0) & (F.col("cum_bat_total") > 0))
            .groupBy(batch_col, feature_col,
                     F.col("cum_ref_total").cast("long").alias("n_ref"),
                     F.col("cum_bat_total").cast("long").alias("n_batch"))
            .agg(F.max(gap).alias("statistic")))
    p = ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_batch"))
    if exact:
        p = F.coalesce(ks_pvalue_exact("statistic", "n_ref", "n_batch"), p)
    return (stat.withColumn("p_value", p)
            .withColumn("drifted", F.col("p_value") < F.lit(alpha)))


def drift_summary(ks: DataFrame, share_limit: float = 0.25, batch_col: str = "batch") -> DataFrame:
    """Per batch: drifted count, tested count, share (0 if none) and verdict (share > limit)."""
    out = ks.groupBy(batch_col).agg(
        F.count_if(F.col("drifted")).cast("long").alias("n_features_drifted"),
        F.count(F.lit(1)).cast("long").alias("total_features"))
    share = F.coalesce(F.try_divide(F.col("n_features_drifted").cast("double"),
                                    F.col("total_features").cast("double")), F.lit(0.0))
    return (out.withColumn("drift_percentage", share)
            .withColumn("dataset_drift", F.col("drift_percentage") > F.lit(share_limit)))


def column_shift(df: DataFrame, columns: list[str], magnitude: float = 5.0,
                 by: list[str] | None = None, where: Column | None = None,
                 max_columns: int | None = None) -> DataFrame:
    """Add ``magnitude * stddev_samp`` to ``columns`` (the first ``max_columns``, if given) with std > 0.

    The std is taken per ``by`` group (e.g. per batch) over the rows selected by
    ``where``; only those rows are shifted.  The per-group std table is joined
    on the group keys (one row per group).
    """
    cols = list(columns)[:max_columns]
    by = by or []
    sel = df if where is None else df.where(where)
    stds = sel.groupBy(*by).agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"__sd_{c}")
                                  for c in cols])
    if by:
        joined = df.join(stds, on=by, how="left")
    else:
        row = stds.first()
        joined = df.withColumns({f"__sd_{c}": F.lit(row[f"__sd_{c}"]).cast("double") for c in cols})
    cond = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    shifted = {}
    for c in cols:
        sd = F.col(f"__sd_{c}")
        shifted[c] = F.when(cond & (sd > 0), F.col(c) + F.lit(magnitude) * sd).otherwise(F.col(c))
    return joined.withColumns(shifted).drop(*[f"__sd_{c}" for c in cols])


def batch_quality(df: DataFrame, label: str, pred: str, batch_col: str = "batch") -> DataFrame:
    """Per batch: confusion counts and f1, accuracy, precision, recall, mcc."""
    counts = confusion_counts(df, label, pred, by=[batch_col])
    m = binary_metrics_from_counts(counts)
    return m.select(batch_col, "tp", "fp", "tn", "fn", "f1_score", "accuracy",
                    "precision", "recall", "mcc")


def monitor_batches(quality: DataFrame, summary: DataFrame, batch_col: str = "batch") -> DataFrame:
    """One row per batch: quality metrics next to the drift verdict."""
    out = quality.join(summary, on=batch_col, how="full")
    return out.withColumn("status", F.when(F.col("dataset_drift"), F.lit("DRIFT"))
                          .otherwise(F.lit("STABLE")))


def monitor_summary(batches: DataFrame) -> DataFrame:
    """Drift batch count, stable batch count, and mean F1 / accuracy of stable batches."""
    stable = ~F.coalesce(F.col("dataset_drift"), F.lit(False))

    def mean(c):  # decimal sums do not depend on the order partial results arrive in
        return F.round(F.avg(F.when(stable, F.col(c).cast("decimal(38,18)"))), 6).cast("double")
    return batches.agg(
        F.count(F.lit(1)).cast("long").alias("n_batches"),
        F.count_if(~stable).cast("long").alias("n_drift_batches"),
        mean("f1_score").alias("stable_mean_f1"),
        mean("accuracy").alias("stable_mean_accuracy"))
