"""Exact running aggregates without a single-task window.

A window ``sum() over (order by x)`` with no (or a skewed) ``partition by`` moves every row of
a key into one task.  At 100 TB that is fatal, and a hot key may hold a third of all rows.
Here the rows are range-partitioned by (keys, order), so that a hot key is cut by its order:

1. ``repartitionByRange`` on the keys and the order, with the window's own directions and null
   places; the partition's number is kept with each row and the result written to the shared
   checkpoint folder (a rerun task reads the same ranges);
2. one row per (partition, key) with the key's aggregate there.  A key needs an offset only if it
   spans partitions: at most two such keys touch each partition, so this table has at most two
   rows a partition, whatever the data, and is broadcast;
3. a window per (partition, key), plus the offset of the key's earlier partitions.

There is one path for every size.  Used by KS, AUC, ROC/PR curves, average precision, medians,
row numbering for splits, batches, version numbers and running maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_PART = "__part"


def _agg(how: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[how](c)


def _merged(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.greatest(a, b) if how == "max" else F.least(a, b)


def running(df: DataFrame, keys: list[str], order: list, measures: dict[str, Column],
            how: str = "sum", descending: bool = False, buckets: int | None = None,
            inclusive: bool = True, totals: bool = False) -> DataFrame:
    """Add running aggregates ``{out_name: measure}`` over ``order`` within ``keys``.

    ``order`` (names, or sort columns) must be unique within ``keys`` (aggregate ties first, or
    append an id); nulls stand where a plain window puts them, and null keys are a key.
    ``buckets`` is the number of ranges, the session's shuffle partitions unless given.
    ``inclusive=False`` gives the aggregate of the rows strictly before the current one.
    ``totals=True`` also adds ``<out_name>_total``: the aggregate over the whole key.
    """
    keys = list(keys)
    tmp = {f"__m_{i}": m for i, m in enumerate(measures.values())}
    sort = [(F.col(o).desc() if descending else F.col(o).asc()) if isinstance(o, str) else o for o in order]
    ranges = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumns(tmp)
    if ranges > 1:  # the ranges are found by a sample: read the input once, not twice
        df = cut_lineage(df)
    dealt = cut_lineage(df.repartitionByRange(ranges, *[F.col(k).asc() for k in keys], *sort)
                        .withColumn(_PART, F.spark_partition_id()))

    per_part = dealt.groupBy(_PART, *keys).agg(*[_agg(how, F.col(t)).alias(t) for t in tmp])
    spread = per_part.groupBy(*keys).agg(F.count(F.lit(1)).alias("__parts"),
                                         F.collect_list(F.struct(_PART, *tmp)).alias("__all")) \
        .where(F.col("__parts") > 1).select(*keys, F.inline("__all"))  # few rows: see the module's text
    up_to = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = spread.select(F.col(_PART).alias("__o_part"), *[F.col(k).alias(f"__o_{i}") for i, k in enumerate(keys)],
                            *[_agg(how, F.col(t)).over(up_to).alias(f"{t}_off") for t in tmp],
                            *[_agg(how, F.col(t)).over(whole).alias(f"{t}_tot") for t in tmp])
    same = F.col(_PART) == F.col("__o_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__o_{i}"))
    joined = dealt.join(F.broadcast(offsets), same, "left")

    here = Window.partitionBy(_PART, *keys)
    w = here.orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    outs = {}
    for name, t in zip(measures, tmp, strict=True):
        outs[name] = _merged(how, _agg(how, F.col(t)).over(w), F.col(f"{t}_off"))
        if totals:
            total = F.when(F.col("__o_part").isNotNull(), F.col(f"{t}_tot")).otherwise(_agg(how, F.col(t)).over(here))
            outs[f"{name}_total"] = total
    return joined.withColumns(outs).drop(_PART, "__o_part", *[f"__o_{i}" for i in range(len(keys))], *tmp,
                                         *[f"{t}_off" for t in tmp], *[f"{t}_tot" for t in tmp])


def row_number(df: DataFrame, keys: list[str], order: list, name: str = "rn",
               buckets: int | None = None, descending: bool = False) -> DataFrame:
    """1-based row number within ``keys`` by ``order`` (unique), scalable form."""
    return running(df, keys, order, {name: F.lit(1).cast("long")}, "sum", descending=descending, buckets=buckets)
