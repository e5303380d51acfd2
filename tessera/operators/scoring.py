"""Scoring with schema alignment.

A scoring table carries either a positional array of values (named by the
first n model columns) or named columns.  Missing model columns become 0,
extra values are dropped, the model's column order is restored, and each row
gets a class, a probability-like score and a label text.  A whole table is
scored in one pass - the reference's row-at-a-time service loop becomes a
projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import lenient_double

# fixed values: label texts of the scoring output
POSITIVE_TEXT = "Heart Disease"
NEGATIVE_TEXT = "No Heart Disease"


def align_positional(df: DataFrame, array_col: str, model_columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Positional values -> named model columns; absent positions -> 0, extras dropped.
    Values are parsed leniently (text that is not a number -> 0)."""
    elem = df.schema[array_col].dataType.elementType
    parse = (lambda c: lenient_double(c)) if isinstance(elem, T.StringType) else (lambda c: c.cast("double"))
    cols = [F.coalesce(parse(F.try_element_at(F.col(array_col), F.lit(i + 1))), F.lit(0.0)).alias(name)
            for i, name in enumerate(model_columns)]
    return df.select(*keep, *cols)


def align_named(df: DataFrame, model_columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Named input: present model columns parsed, missing ones 0, others dropped, model order."""
    cols = [(F.coalesce(lenient_double(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c)
            for c in model_columns]
    return df.select(*keep, *cols)


def linear_scorer(weights: dict[str, float], intercept: float = 0.0):
    """A fixed linear model: score = sigmoid(b + w.x), class = score >= 0.5."""
    def score(df: DataFrame) -> Column:
        z = F.lit(intercept)
        for c, w in weights.items():
            z = z + F.lit(w) * F.col(c)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return score


def score_table(aligned: DataFrame, scorer, threshold: float = 0.5) -> DataFrame:
    s = scorer(aligned)
    out = aligned.withColumn("score", s)
    pred = (F.col("score") >= F.lit(threshold)).cast("int")
    return out.withColumns({"prediction": pred,
                            "label_text": F.when(pred == 1, F.lit(POSITIVE_TEXT)).otherwise(F.lit(NEGATIVE_TEXT))})


def score_totals(scored: DataFrame) -> DataFrame:
    """total rows and positive ('disease') count of a scored table."""
    return scored.agg(F.count(F.lit(1)).cast("long").alias("total"),
                      F.count_if(F.col("prediction") == 1).cast("long").alias("disease_count"))
