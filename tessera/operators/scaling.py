"""Standardisation with statistics fitted on one split and applied to all.

The fit is one aggregate row (mean and population std per column), brought to
the driver as literals: its size is bounded by the column count, and literals
keep the apply step a narrow projection inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class ScalerModel:
    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - mean) / std; a zero (or undefined) std divides by 1, as the reference's scaler."""
        out = {}
        for c, mu in self.means.items():
            sd = self.stds[c]
            scale = sd if sd and sd > 0 else 1.0
            out[c + suffix] = (F.col(c).cast("double") - F.lit(mu or 0.0)) / F.lit(scale)
        return df.withColumns(out)


def fit_scaler(df: DataFrame, columns: list[str]) -> ScalerModel:
    aggs = []
    for c in columns:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first().asDict()
    return ScalerModel({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] for c in columns})


def standardise(df: DataFrame, columns: list[str], fit_on=None, suffix: str = "") -> DataFrame:
    """Fit on ``df.where(fit_on)`` (default: all rows) and transform all rows."""
    src = df if fit_on is None else df.where(fit_on)
    return fit_scaler(src, columns).transform(df, suffix)
