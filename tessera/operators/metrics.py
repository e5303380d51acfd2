"""Classification metrics as plain aggregates.

Everything is a grouped aggregate (optionally ``by`` model / batch keys), so a
billion scored rows reduce map-side to a handful of counts.  Score-ordered
quantities (AUC, curves, average precision) first collapse to one row per
distinct score, then use the bounded two-level running sum.

Conventions follow the reference's metric library: any ratio with a zero
denominator is 0, AUC ties count half, average precision is the step-wise
sum over distinct thresholds, log loss clips probabilities at machine epsilon.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import prefix

EPS = sys.float_info.epsilon


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label, pred, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp (long) per ``by`` group in one pass."""
    by = by or []
    y = _c(label).cast("int")
    p = _c(pred).cast("int")
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"),
        F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"))


def binary_metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Closed forms of the confusion counts (products taken in double)."""
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    specificity = _ratio(tn, tn + fp)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    po = _ratio(tp + tn, n)
    pe = _ratio((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    return counts.withColumns({
        "accuracy": po,
        "precision": precision,
        "recall": recall,
        "specificity": specificity,
        "f1_score": _ratio(2.0 * tp, 2.0 * tp + fp + fn),
        "balanced_accuracy": (recall + specificity) / 2.0,
        "mcc": _ratio(tp * tn - fp * fn, mcc_den),
        "cohen_kappa": _ratio(po - pe, F.lit(1.0) - pe),
    })


def binary_metrics(df: DataFrame, label, pred, by: list[str] | None = None) -> DataFrame:
    return binary_metrics_from_counts(confusion_counts(df, label, pred, by))


def confusion_matrix(df: DataFrame, label, pred, by: list[str] | None = None) -> DataFrame:
    """Long confusion matrix: (actual, predicted, n, pct of the actual row)."""
    by = by or []
    cells = (df.groupBy(*by, _c(label).cast("int").alias("actual"),
                        _c(pred).cast("int").alias("predicted"))
             .agg(F.count(F.lit(1)).cast("long").alias("n")))
    totals = cells.groupBy(*by, "actual").agg(F.sum("n").alias("__row_total"))
    return (cells.join(totals, on=by + ["actual"])
            .withColumn("pct", F.col("n") * 100.0 / F.col("__row_total"))
            .drop("__row_total"))


def log_loss(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    by = by or []
    y = _c(label).cast("double")
    p = F.least(F.greatest(_c(score).cast("double"), F.lit(EPS)), F.lit(1.0 - EPS))
    return df.groupBy(*by).agg(
        F.avg(-(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss"))


def score_counts(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    """One row per (by..., distinct score): pos, neg."""
    by = by or []
    y = _c(label).cast("int")
    return (df.groupBy(*by, _c(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).cast("long").alias("pos"),
                 F.count_if(y != 1).cast("long").alias("neg")))


def _join_total(sc: DataFrame, tot: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return sc.join(tot, on=by)
    row = tot.first()  # two counts: a fitted scalar, not data
    return sc.withColumns({"P": F.lit(row["P"]).cast("long"), "N": F.lit(row["N"]).cast("long")})


def roc_auc(df: DataFrame, label, score, by: list[str] | None = None,
            buckets: int | None = None) -> DataFrame:
    """Mann-Whitney AUC with half-counted ties; null when one class is absent."""
    by = by or []
    sc = score_counts(df, label, score, by)
    cum = prefix.running(sc, by, ["score"], {"neg_below": F.col("neg")},
                         inclusive=False, buckets=buckets)
    out = cum.groupBy(*by).agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_below").cast("double")
                                             + F.col("neg").cast("double") / 2.0)).alias("__u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("__u") / (F.col("P").cast("double") * F.col("N").cast("double")))
    return out.select(*by, auc.alias("auc"))


def roc_points(df: DataFrame, label, score, by: list[str] | None = None,
               buckets: int | None = None) -> DataFrame:
    """One row per distinct score, descending: cumulative tp, fp and P, N."""
    by = by or []
    sc = score_counts(df, label, score, by)
    cum = prefix.running(sc, by, ["score"], {"tp": F.col("pos"), "fp": F.col("neg")},
                         descending=True, buckets=buckets)
    tot = sc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return _join_total(cum, tot, by)


def roc_curve(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, descending."""
    by = by or []
    pts = roc_points(df, label, score, by)
    return pts.select(*by, F.col("score").alias("threshold"),
                      _ratio(F.col("fp"), F.col("N")).alias("fpr"),
                      _ratio(F.col("tp"), F.col("P")).alias("tpr"))


def youden(df: DataFrame, label, score, by: list[str] | None = None, digits: int = 9) -> DataFrame:
    """Threshold with the largest tpr - fpr (rounded); ties -> the highest threshold."""
    by = by or []
    curve = roc_curve(df, label, score, by).withColumn("j", F.round(F.col("tpr") - F.col("fpr"), digits))
    best = curve.groupBy(*by).agg(F.max(F.struct("j", "threshold", "tpr", "fpr")).alias("b"))
    return best.select(*by, F.col("b.threshold").alias("threshold"), F.col("b.j").alias("youden_j"),
                       F.col("b.tpr").alias("tpr"), F.col("b.fpr").alias("fpr"))


def pr_curve(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, descending."""
    by = by or []
    pts = roc_points(df, label, score, by)
    return pts.select(*by, F.col("score").alias("threshold"),
                      _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      _ratio(F.col("tp"), F.col("P")).alias("recall"))


def avg_precision(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    """Sum over distinct thresholds of (recall step) * precision."""
    by = by or []
    pts = roc_points(df, label, score, by)
    step = _ratio(F.col("pos"), F.col("P")) * _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return pts.groupBy(*by).agg(F.sum(step).alias("avg_precision"))


def class_report(df: DataFrame, label, pred, by: list[str] | None = None) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro and weighted avg.

    Classes are the union of labels and predictions.  The accuracy row carries
    accuracy in ``f1_score`` and nulls in precision / recall, as the report does.
    """
    by = by or []
    pairs = (df.groupBy(*by, _c(label).cast("string").alias("y"), _c(pred).cast("string").alias("p"))
             .agg(F.count(F.lit(1)).cast("long").alias("n")))
    true_side = pairs.groupBy(*by, F.col("y").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))).alias("tp"))
    pred_side = pairs.groupBy(*by, F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (true_side.join(pred_side, on=by + ["cls"], how="full")
           .select(*by, "cls",
                   F.coalesce("support", F.lit(0)).cast("long").alias("support"),
                   F.coalesce("tp", F.lit(0)).cast("long").alias("tp"),
                   F.coalesce("predicted", F.lit(0)).cast("long").alias("predicted")))
    per = per.withColumns({
        "precision": _ratio(F.col("tp"), F.col("predicted")),
        "recall": _ratio(F.col("tp"), F.col("support")),
        "f1_score": _ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support")),
    })
    classes = per.select(*by, F.col("cls").alias("class"), "precision", "recall", "f1_score", "support")
    tot = per.groupBy(*by).agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1_score").alias("m_f"),
        F.sum(F.col("precision") * F.col("support")).alias("w_p"),
        F.sum(F.col("recall") * F.col("support")).alias("w_r"),
        F.sum(F.col("f1_score") * F.col("support")).alias("w_f"))
    acc = tot.select(*by, F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     _ratio(F.col("tp"), F.col("support")).alias("f1_score"), "support")
    macro = tot.select(*by, F.lit("macro avg").alias("class"), F.col("m_p").alias("precision"),
                       F.col("m_r").alias("recall"), F.col("m_f").alias("f1_score"), "support")
    weighted = tot.select(*by, F.lit("weighted avg").alias("class"),
                          _ratio(F.col("w_p"), F.col("support")).alias("precision"),
                          _ratio(F.col("w_r"), F.col("support")).alias("recall"),
                          _ratio(F.col("w_f"), F.col("support")).alias("f1_score"), "support")
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)


def ranking(df: DataFrame, label, score, by: list[str] | None = None) -> DataFrame:
    """(auc, avg_precision) from one table of score counts and one running sum."""
    by = by or []
    pts = roc_points(df, label, score, by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = F.col("N").cast("double") - F.col("fp").cast("double") + neg / 2.0
    step = _ratio(F.col("pos"), F.col("P")) * _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    out = pts.groupBy(*by).agg(F.sum(pos * below).alias("u"), F.max("P").alias("P"), F.max("N").alias("N"), F.sum(step).alias("avg_precision"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P").cast("double") * F.col("N").cast("double")))
    return out.select(*by, auc.alias("auc"), "avg_precision")


def evaluate(df: DataFrame, label, pred, score, by: list[str] | None = None) -> DataFrame:
    """The full metric row of a model: counts, ratios, AUC, log loss, average precision."""
    by = by or []
    base = binary_metrics(df, label, pred, by)
    for e in (ranking(df, label, score, by), log_loss(df, label, score, by)):
        base = base.join(e, on=by) if by else _join_scalar_row(base, e)
    return base


def _join_scalar_row(base: DataFrame, one_row: DataFrame) -> DataFrame:
    row = one_row.first()
    return base.withColumns({k: F.lit(v).cast("double") for k, v in row.asDict().items()})
