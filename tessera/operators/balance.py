"""SMOTE: synthetic minority over-sampling as joins.

Every label with fewer rows than the largest label grows to that size.  For
label L with n rows and ``need = n_max - n`` synthetic rows, synthetic row i
(0 <= i < need) is

    base  = the row of index hash(L|i, 'b') mod n        (index = hash order)
    nb    = base's neighbour of rank 1 + hash(L|i, 'n') mod min(k, n - 1)
    u     = hash_u(L|i, 'u')                             in [0, 1)
    x     = base + u * (nb - base)

Neighbours are exact k-nearest within the label (``neighbours.nearest``).
The i's are generated as chunk ranges, so a label needing a billion rows is
spread over many tasks; rows meet their base / neighbour by equi-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import DEFAULT_SEED, hash_u
from tessera.operators.neighbours import nearest
from tessera.operators.sampling import hash_rank

CHUNK = 100_000
_TWO_32 = 4294967296


def _hash_int(key, tag: str, seed: int):
    return F.floor(hash_u(key, tag, seed) * F.lit(float(_TWO_32))).cast("long")


def smote(df: DataFrame, id_col: str, label_col: str, vec_col: str, k: int = 5,
          seed: int = DEFAULT_SEED, n_pivots: int | None = None) -> DataFrame:
    """Return the synthetic rows: (label, synthetic_index, base_id, neighbour_id, u, vec).

    A label of a single row cannot be interpolated and raises an error.
    """
    if df.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).limit(1).count():
        raise ValueError(f"{id_col} must be unique: rows that share an id would be drawn together")
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__n"))
    stats = sizes.agg(F.max("__n").alias("mx"), F.min("__n").alias("mn")).first()
    if stats["mx"] is None or stats["mx"] == stats["mn"]:
        return df.sparkSession.createDataFrame(
            [], f"{label_col} {df.schema[label_col].dataType.simpleString()}, synthetic_index long, "
                f"base_id {df.schema[id_col].dataType.simpleString()}, "
                f"neighbour_id {df.schema[id_col].dataType.simpleString()}, u double, {vec_col} array<double>")
    n_max = stats["mx"]
    need = (sizes.where(F.col("__n") < n_max)
            .withColumn("__need", F.lit(n_max) - F.col("__n")))
    if need.where(F.col("__n") < 2).limit(1).count() > 0:
        raise ValueError("SMOTE needs at least two rows in every label to be grown")

    minority = df.join(need.select(label_col), on=label_col, how="left_semi")
    indexed = hash_rank(minority, id_col, [label_col], name="__idx", seed=seed, tag="idx") \
        .withColumn("__idx", F.col("__idx") - 1)
    neigh = nearest(minority.select(label_col, F.col(id_col).alias("qid"), F.col(vec_col).alias("vec")),
                    minority.select(label_col, F.col(id_col).alias("rid"), F.col(vec_col).alias("vec")),
                    k, "qid", "rid", "vec", by=[label_col], exclude_self=True, n_pivots=n_pivots)

    chunks = need.select(label_col, "__n", "__need",
                         F.explode(F.sequence(F.lit(0).cast("long"),
                                              F.floor((F.col("__need") - 1) / CHUNK).cast("long"))).alias("__chunk"))
    chunks = chunks.repartition(label_col, "__chunk")
    gen = chunks.select(label_col, "__n", F.explode(F.sequence(
        F.col("__chunk") * CHUNK,
        F.least((F.col("__chunk") + 1) * CHUNK, F.col("__need")) - 1)).alias("synthetic_index"))
    key = F.concat_ws("|", F.col(label_col).cast("string"), F.col("synthetic_index").cast("string"))
    kk = F.least(F.lit(k).cast("long"), F.col("__n") - 1)
    gen = gen.select(label_col, "synthetic_index",
                     F.pmod(_hash_int(key, "b", seed), F.col("__n")).alias("__idx"),
                     (F.pmod(_hash_int(key, "n", seed), kk) + 1).alias("rank"),
                     hash_u(key, "u", seed).alias("u"))

    base = indexed.select(label_col, "__idx", F.col(id_col).alias("base_id"), F.col(vec_col).alias("__bvec"))
    gen = gen.join(base, on=[label_col, "__idx"])
    nb = neigh.select(F.col("qid").alias("base_id"), "rank", F.col("rid").alias("neighbour_id"))
    gen = gen.join(nb, on=["base_id", "rank"])
    nvec = minority.select(F.col(id_col).alias("neighbour_id"), F.col(vec_col).alias("__nvec"))
    gen = gen.join(nvec, on="neighbour_id")
    u = F.col("u")
    interp = F.zip_with("__bvec", "__nvec",
                        lambda a, b: a.cast("double") + u * (b.cast("double") - a.cast("double")))
    return gen.select(label_col, "synthetic_index", "base_id", "neighbour_id", "u", interp.alias(vec_col))
