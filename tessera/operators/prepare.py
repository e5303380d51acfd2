"""Preparation of a harmonised table for learning, as one lazy plan.

label separation -> numeric coercion -> NULL/NaN/inf repair -> stratified
70/15/15 split -> standardisation fitted on train -> SMOTE on train only.
The result is one table with ``split``, the integer label, the features and a
``synthetic`` flag; ``write_splits`` stores it partitioned by split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import DEFAULT_SEED
from tessera.operators import prefix
from tessera.operators.balance import smote
from tessera.operators.columns import coerce_numeric, fill_const
from tessera.operators.sampling import stratified_split
from tessera.operators.scaling import fit_scaler
from tessera.session import cut_lineage


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add a unique text id: a hash of the row's content and its number among equal rows.

    Equal rows are interchangeable, so the set of (row, id) does not depend on the partitioning;
    equal rows may be many: they are numbered across tasks.
    """
    hashed = df.withColumns({"__hash": F.xxhash64(*df.columns), "__at": F.monotonically_increasing_id()})
    numbered = prefix.row_number(cut_lineage(hashed), ["__hash"], ["__at"], name="__nth")
    return numbered.withColumn(name, F.concat_ws("-", F.hex("__hash"), "__nth")).drop("__hash", "__at", "__nth")


def prepare_splits(df: DataFrame, target: str, test_size: float = 0.15, val_size: float = 0.15,
                   seed: int = DEFAULT_SEED, apply_smote: bool = True, k: int = 5,
                   id_col: str | None = None) -> DataFrame:
    if "source" in df.columns:
        df = df.drop("source")
    if id_col is None:
        id_col = "row_id"
        df = with_row_id(df, id_col)
    df = df.withColumn(target, F.col(target).cast("int"))
    features = [c for c in df.columns if c not in (target, id_col)]
    df = fill_const(coerce_numeric(df, exclude=(id_col,)).select(id_col, target, *[F.col(c).cast("double") for c in features]),
                    0.0, features)
    df = stratified_split(df, id_col, target, test_size, val_size, seed)
    scaler = fit_scaler(df.where(F.col("split") == "train"), features)
    df = scaler.transform(df).withColumn("synthetic", F.lit(False))
    if not apply_smote:
        return df
    train = df.where(F.col("split") == "train").select(id_col, target, F.array(*features).alias("__vec"))
    syn = smote(train, id_col, target, "__vec", k, seed)
    syn_rows = syn.select(
        F.concat_ws("-", F.lit("synthetic"), F.col(target), F.col("synthetic_index")).cast(df.schema[id_col].dataType).alias(id_col)
        if isinstance(df.schema[id_col].dataType, T.StringType) else
        F.xxhash64(F.lit("synthetic"), F.col(target), F.col("synthetic_index")).alias(id_col),
        F.col(target).cast("int").alias(target),
        *[F.col("__vec")[i].alias(c) for i, c in enumerate(features)],
        F.lit("train").alias("split"), F.lit(True).alias("synthetic"))
    return df.unionByName(syn_rows)
