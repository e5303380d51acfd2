"""Shared pieces of the query bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import read_table

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (engines differ in the last bits of sums)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(F.col(f.name).cast("double"), digits)
    return df.withColumns(out) if out else df


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, list(columns) or None)
