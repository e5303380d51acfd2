"""A join to a table of unique keys that frequent keys can't slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

FREQUENT_KEYS = 1_000
FEW_ROWS = 1_000


def lookup(df: DataFrame, table: DataFrame, key: str, rows: int, how: str = "inner") -> DataFrame:
    """``df`` joined to ``table`` (one row a key) by ``key``; ``how`` is inner or left.

    Keys that hold more than 1 / FREQUENT_KEYS of the ``rows`` of ``df`` (and more than FEW_ROWS) get their
    values by broadcast: there are fewer than FREQUENT_KEYS of them, whatever the data.  All
    other rows are shuffled, and no key of theirs is large; null keys aren't shuffled.  ``df`` and ``table`` are read twice.
    """
    limit = max(FEW_ROWS, rows // FREQUENT_KEYS)
    known = df.filter(F.col(key).isNotNull())
    often = cut_lineage(known.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(key))
    if often.take(1):
        frequent = known.join(F.broadcast(often.join(table, key, how)), key)  # below FREQUENT_KEYS rows
        out = frequent.unionByName(known.join(F.broadcast(often), key, "left_anti").join(table, key, how))
    else:
        out = known.join(table, key, how)
    if how != "left":
        return out
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name != key]
    return out.unionByName(df.filter(F.col(key).isNull()).select("*", *missing))
