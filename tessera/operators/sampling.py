"""Splitting, sampling, batching and class-balance reporting.

All randomness is ``md5(seed|id)``: a row's fate depends only on its id, never
on partitioning.  Splits and batches label rows where they are, by comparing them with cut-offs:
``hash_cuts`` finds the k-th smallest hash of every label by refining digit histograms, and only
(label, digits, count) rows are shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import DEFAULT_SEED, hash_hex
from tessera.operators import prefix
from tessera.session import cut_lineage


def hash_rank(df: DataFrame, id_col: str, keys: list[str] | None = None, name: str = "rn",
              seed: int = DEFAULT_SEED, tag: str = "", buckets: int | None = None) -> DataFrame:
    """1-based rank within ``keys`` by (md5(seed|tag|id), id)."""
    keys = keys or []
    df = df.withColumn("__h", hash_hex(F.col(id_col), tag, seed))
    return prefix.row_number(df, keys, ["__h", id_col], name=name, buckets=buckets).drop("__h")


DIGITS = 4  # hex digits of the hash by round: 65,536 bins a label
FEW = 10_000  # rows of a boundary bin that are ranked directly


def hash_cuts(hashed: DataFrame, key: str, wanted: DataFrame, id_col: str, h: str = "__h") -> DataFrame:
    """(key, cut, at): for each row (key, cut, k) of ``wanted`` the k-th smallest (hash, id) struct of the key's rows.

    Each round counts the rows by (key, leading digits) and keeps, for each cut, the bin that holds
    its row; the next round counts only the rows of those bins, by more digits.  Bins of FEW rows are ranked
    directly (a bin that the digits can't part holds equal hashes, that is one id).
    """
    digits = DIGITS
    rows = hashed.select(F.col(key).alias("__k"), F.col(h).alias("__h"), F.col(id_col).alias("__id"))
    cuts = wanted.select(F.col(key).alias("__k"), "cut", F.col("k").cast("long").alias("k")).where("k > 0").withColumn("__pre", F.lit(""))
    while True:
        bins = F.substring("__h", 1, digits)
        known = cuts.select(F.col("__k").alias("__ck"), "__pre").distinct()  # at most a row a cut
        inside = F.col("__k").eqNullSafe(F.col("__ck")) & (F.substring("__h", 1, digits - DIGITS) == F.col("__pre"))
        counted = rows.join(known, inside).groupBy("__k", "__pre", bins.alias("__bin")).agg(F.count(F.lit(1)).alias("__n"))
        upto = Window.partitionBy("__k", "__pre").orderBy("__bin")  # 16 ** DIGITS rows at most
        counted = counted.withColumn("__to", F.sum("__n").over(upto)).select(F.col("__k").alias("__ck"), F.col("__pre").alias("__cp"), "__bin", "__n", "__to")
        held = F.col("__k").eqNullSafe(F.col("__ck")) & (F.col("__pre") == F.col("__cp")) & (F.col("k") <= F.col("__to")) & (F.col("k") > F.col("__to") - F.col("__n"))
        cuts = cut_lineage(cuts.join(counted, held).select("__k", "cut", (F.col("k") - (F.col("__to") - F.col("__n"))).alias("k"), F.col("__bin").alias("__pre"), "__n"))
        most = cuts.agg(F.max("__n")).first()[0] or 0
        if most <= FEW or digits >= 32:
            break
        cuts, digits = cuts.drop("__n"), digits + DIGITS
    known = cuts.select(F.col("__k").alias("__ck"), "__pre").distinct()
    inside = F.col("__k").eqNullSafe(F.col("__ck")) & (F.substring("__h", 1, digits) == F.col("__pre"))
    place = Window.partitionBy("__ck", "__pre").orderBy("__h", "__id")
    last = rows.join(known, inside).groupBy("__ck", "__pre", "__h", "__id").agg(F.count(F.lit(1)).alias("__m"))
    last = last.withColumn("__to", F.sum("__m").over(place)).withColumnRenamed("__pre", "__cp")
    held = F.col("__k").eqNullSafe(F.col("__ck")) & (F.col("__pre") == F.col("__cp")) & (F.col("k") <= F.col("__to")) & (F.col("k") > F.col("__to") - F.col("__m"))
    return cuts.join(last, held).select(F.col("__k").alias(key), "cut", F.struct("__h", "__id").alias("at"))


def stratified_split(df: DataFrame, id_col: str, label_col: str, test_size: float = 0.15,
                     val_size: float = 0.15, seed: int = DEFAULT_SEED,
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` in {train, val, test}, keeping each label's share.

    Per label with n rows: the first round(n*test) by hash order are test, the
    next round((n - n_test) * val / (1 - test)) are val, the rest train.  Rows that share an
    id share their split (that of the cut-off's side on which the id stands).  No row is shuffled.
    """
    hashed = df.withColumn("__h", hash_hex(F.col(id_col), "", seed))
    n = F.col("__n").cast("double")
    n_test = F.round(n * F.lit(test_size))
    n_val = F.round((n - n_test) * F.lit(val_size / (1.0 - test_size)))
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__n"))
    wanted = cut_lineage(sizes.select(label_col, F.explode(F.array(F.struct(F.lit("test").alias("cut"), n_test.alias("k")),
                                                                   F.struct(F.lit("val").alias("cut"), (n_test + n_val).alias("k")))).alias("c"))
                         .select(label_col, "c.cut", "c.k"))
    at = hash_cuts(hashed, label_col, wanted, id_col)
    ends = at.groupBy(F.col(label_col).alias("__l")).agg(F.max(F.when(F.col("cut") == "test", F.col("at"))).alias("__test"),
                                                         F.max(F.when(F.col("cut") == "val", F.col("at"))).alias("__val"))
    out = hashed.join(ends, F.col(label_col).eqNullSafe(F.col("__l")), "left")  # one row a label: Spark broadcasts it when small
    me = F.struct(F.col("__h"), F.col(id_col).alias("__id"))
    split = F.when(me <= F.col("__test"), F.lit("test")).when(me <= F.col("__val"), F.lit("val")).otherwise(F.lit("train"))
    return out.withColumn(split_col, split).drop("__h", "__l", "__test", "__val")


def sample_fixed(df: DataFrame, id_col: str, k: int, seed: int = DEFAULT_SEED,
                 by: list[str] | None = None) -> DataFrame:
    """Uniform sample of exactly min(k, n) rows per ``by`` group, without replacement."""
    hashed = df.withColumn("__h", hash_hex(F.col(id_col), "s", seed))
    if not by:  # top k per task, then of those
        return hashed.orderBy("__h", id_col).limit(k).drop("__h")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("__h", id_col))  # k a group and task at most
    return hashed.withColumn("__rn", rank).where(F.col("__rn") <= F.lit(k)).drop("__rn", "__h")


def batch_slice(df: DataFrame, order: list[str], n_batches: int = 5, max_size: int | None = None,
                batch_col: str = "batch") -> DataFrame:
    """Contiguous batches by ``order`` of n // n_batches rows (at most ``max_size``, if given):
    batch i (1-based) holds ranks ((i-1)*size, i*size]; the remainder is left out.  ``order`` is unique;
    only its columns are ranked, and the rows are labelled where they are.
    """
    n = df.count()
    size = n // n_batches if max_size is None else min(max_size, n // n_batches)
    if size <= 0:
        return df.withColumn(batch_col, F.lit(None).cast("int")).limit(0)
    ranked = prefix.row_number(df.select(*order), [], order, name="__rn")  # the order's columns only
    last = ranked.where((F.col("__rn") % size == 0) & (F.col("__rn") <= size * n_batches))
    ends = sorted(last.select("__rn", F.struct(*order).alias("at")).collect())  # one row a batch
    ends = df.sparkSession.createDataFrame([(i + 1, r["at"]) for i, r in enumerate(ends)], T.StructType(
        [T.StructField("__b", T.IntegerType()), T.StructField("__at", last.select(F.struct(*order).alias("at")).schema["at"].dataType)]))
    ends = ends.agg(F.sort_array(F.collect_list(F.struct("__b", "__at"))).alias("__ends"))
    me = F.struct(*order)
    first = F.get(F.filter("__ends", lambda e: me <= e["__at"]), F.lit(0))["__b"]
    return (df.withColumn("__ends", ends.scalar()).withColumn(batch_col, first)  # one array of ``n_batches`` cut-offs
            .where(F.col(batch_col).isNotNull()).drop("__ends"))


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Counts per label, share, and min/max ratio over labels."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).cast("long").alias("n"))
    w = Window.partitionBy()  # over the per-label table: one row per label
    return counts.select(
        label_col, "n",
        (F.col("n") / F.sum("n").over(w)).alias("share"),
        (F.min("n").over(w) / F.max("n").over(w)).alias("balance_ratio"))
