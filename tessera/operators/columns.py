"""Column shaping and null/domain repair.

All of these are narrow projections (no shuffle).  The two "fits" - one-hot
levels and column medians - are one aggregate each whose result is bounded by
the number of levels / columns; they are returned so that other splits and
streams reuse them instead of re-discovering them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import lenient_double
from tessera.operators.lookup import lookup
from tessera.operators.prefix import row_number
from tessera.session import cut_lineage

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_columns(df: DataFrame, fixed: list[str], prefixes: list[str] = ()) -> DataFrame:
    """Keep the fixed names that exist plus every column starting with a prefix."""
    cols = [c for c in fixed if c in df.columns]
    cols += [c for c in df.columns if any(c.startswith(p) for p in prefixes) and c not in cols]
    return df.select(*cols)


def tag_source(df: DataFrame, source: str, col: str = "source") -> DataFrame:
    return df.withColumn(col, F.lit(source))


def coerce_numeric(df: DataFrame, exclude=("source",)) -> DataFrame:
    """Every string column -> double, unparsable text -> null."""
    out = {f.name: lenient_double(f.name) for f in df.schema.fields
           if isinstance(f.dataType, T.StringType) and f.name not in exclude}
    return df.withColumns(out) if out else df


def fill_const(df: DataFrame, value: float = 0.0, columns: list[str] | None = None) -> DataFrame:
    """NULL, NaN and +/-inf -> ``value`` in the numeric columns."""
    cols = columns or numeric_columns(df)
    out = {}
    for c in cols:
        col = F.col(c)
        dtype = df.schema[c].dataType
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            bad = col.isNull() | F.isnan(col) | col.isin(float("inf"), float("-inf"))
            out[c] = F.when(bad, F.lit(value).cast(dtype)).otherwise(col)
        else:
            out[c] = F.coalesce(col, F.lit(value).cast(dtype))
    return df.withColumns(out)


def fit_medians(df: DataFrame, columns: list[str] | None = None) -> dict[str, float | None]:
    """Exact (interpolated) median per column, NULL and NaN skipped; None without a value.

    All columns in one pass: (column, distinct value) counts, their running sums, and of these
    the values that hold the two middle ranks.  No column is ever gathered in one task.
    """
    from tessera.operators import prefix
    cols = columns or numeric_columns(df)
    if not cols:
        return {}
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    long = wide.unpivot([], [f"c{i}" for i in range(len(cols))], "c", "v")
    counts = (long.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("c", "v")
              .agg(F.count(F.lit(1)).alias("n")))
    cum = prefix.running(counts, ["c"], ["v"], {"cum": F.col("n")}, totals=True)
    low, high = F.floor((F.col("cum_total") - 1) / 2), F.floor(F.col("cum_total") / 2)
    middle = cum.groupBy("c").agg(F.min(F.when(F.col("cum") > low, F.col("v"))).alias("lo"),
                                  F.min(F.when(F.col("cum") > high, F.col("v"))).alias("hi"))
    found = {r["c"]: r["lo"] if r["lo"] == r["hi"] else (r["lo"] + r["hi"]) / 2.0 for r in middle.collect()}
    return {c: found.get(f"c{i}") for i, c in enumerate(cols)}


def exact_median(df: DataFrame, column: str) -> float | None:
    """The exact (interpolated) median of one column."""
    return fit_medians(df, [column])[column]


def fill_median(df: DataFrame, columns: list[str] | None = None,
                medians: dict[str, float | None] | None = None) -> DataFrame:
    """Fill NULL/NaN with the column median (fitted on ``df`` unless given)."""
    cols = columns or numeric_columns(df)
    med = medians or fit_medians(df, cols)
    out = {}
    for c in cols:
        if med.get(c) is None:
            continue
        col = F.col(c).cast("double")
        out[c] = F.when(col.isNull() | F.isnan(col), F.lit(float(med[c]))).otherwise(col)
    return df.withColumns(out)


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_null): NULL (and NaN for floating columns) per column, one pass."""
    cols = columns or df.columns
    aggs = []
    for c in cols:
        col = F.col(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            aggs.append(F.count_if(col.isNull() | F.isnan(col)).cast("long").alias(c))
        else:
            aggs.append(F.count_if(col.isNull()).cast("long").alias(c))
    wide = df.agg(*aggs)
    return wide.unpivot([], cols, "column_name", "n_null")


@dataclass
class OneHotModel:
    column: str
    prefix: str
    levels: list

    def names(self) -> list[str]:
        return [f"{self.prefix}_{lvl}" for lvl in self.levels]

    def transform(self, df: DataFrame, drop: bool = True) -> DataFrame:
        """One 0/1 int column per fitted level; null or unseen -> all zeros."""
        out = {name: F.coalesce(F.col(self.column) == F.lit(lvl), F.lit(False)).cast("int")
               for name, lvl in zip(self.names(), self.levels)}
        df = df.withColumns(out)
        return df.drop(self.column) if drop else df


MAX_LEVELS = 1000


def fit_one_hot(df: DataFrame, column: str, prefix: str | None = None,
                max_levels: int = MAX_LEVELS) -> OneHotModel:
    """Levels = sorted distinct non-null values (a distinct aggregate).  Only
    ``max_levels + 1`` levels are ever fetched: more don't fit in columns (see ``one_hot_sparse``)."""
    levels = [r[0] for r in df.select(column).where(F.col(column).isNotNull())
              .distinct().limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; one-hot columns would not fit")
    return OneHotModel(column, prefix or column, sorted(levels))


def level_table(df: DataFrame, column: str) -> DataFrame:
    """(column, index): the distinct non-null values, numbered from 0 in their order; it stays in Spark."""
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return row_number(levels, [], [column], name="index").withColumn("index", F.col("index") - 1)


def one_hot_sparse(df: DataFrame, column: str, levels: DataFrame | None = None, out: str | None = None, drop: bool = True) -> DataFrame:
    """``df`` with one sparse vector column: a 1 at the level's index; null or unseen -> all zeros.

    Any number of levels: the level table (``level_table``, or the one given) is joined, with frequent levels
    by a bounded broadcast, and only its size reaches the driver.
    """
    from pyspark.ml.feature import OneHotEncoder

    out = out or f"{column}_vector"
    levels = cut_lineage(level_table(df, column) if levels is None else levels)
    size = levels.count()
    named = levels.select(F.col(column).alias("__level"), F.col("index").alias("__index"))
    found = lookup(df.withColumn("__level", F.col(column)), named, "__level", df.count(), "left")
    found = found.withColumn("__index", F.coalesce("__index", F.lit(size)).cast("double"))  # beyond the last level: zeros
    top = df.sparkSession.createDataFrame([(float(max(size, 1) - 1),)], "__index double")
    encoder = OneHotEncoder(inputCols=["__index"], outputCols=[out], handleInvalid="keep", dropLast=True).fit(top)
    made = encoder.transform(found).drop("__level", "__index")
    return made.drop(column) if drop else made


def one_hot(df: DataFrame, column: str, prefix: str | None = None, drop: bool = True, max_levels: int = MAX_LEVELS) -> DataFrame:
    """One column a level (``prefix_level``); above ``max_levels`` levels one sparse vector column, ``prefix_vector``."""
    if df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_levels + 1).count() > max_levels:
        return one_hot_sparse(df, column, out=f"{prefix or column}_vector", drop=drop)
    return fit_one_hot(df, column, prefix, max_levels).transform(df, drop)
