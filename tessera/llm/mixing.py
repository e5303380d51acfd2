"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. ``targets``: each source's share of the mix, in words.  A target stops at ``max_repeats``
   times its source's words; the excess is reshared by weight until none is above.
2. ``draw``: each source's documents stand in a hashed order (md5 of seed and id) and are cut
   into blocks of ``block_words``.  A source gives whole passes over its blocks plus the first
   blocks of one more pass; (pass, block) is a unit, and a source's unit count is its quota.
3. The splitting tree parts the quota vector exactly among the output shards: each node draws
   its left child's quotas from a multivariate hypergeometric law seeded by the node, so every
   shard's walk from the root is computed on its own and all walks agree.
4. A keyed permutation of each source's units gives every shard disjoint blocks; ``mix``
   shuffles each shard locally by a hash.

Only whole documents are drawn: the last one of a source's partial pass is taken if at least
half of it fits, so a source's words miss its target by half of one document at most.

Size of what leaves Spark: one row per source (its words), as targets are set per source; the
documents, blocks and shards stay in Spark.  A hot source is spread over hash ranges.

Defined results: a null text has 0 words; null is a source of its own; a source without words
has target 0 and gives nothing; repeated rows are documents of their own; an empty table gives
an empty mix; other columns are carried along by ``mix``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, hash_order
from tessera.session import cut_lineage

BLOCK_WORDS = 65_536
SHARD_BLOCKS = 32
MAX_REPEATS = 3
SEED = "mix-1"


def targets(words: list[int], weights: list[float], total: float, max_repeats: int = MAX_REPEATS) -> list[float]:
    """Target words per source: ``total`` by weight, at most ``max_repeats`` times the source's words."""
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(words)) if i not in capped]
        rest = total - sum(max_repeats * words[i] for i in capped)
        weight = sum(weights[i] for i in free)
        level = rest / weight if weight else 0.0
        above = {i for i in free if level * weights[i] > max_repeats * words[i]}
        if not above:
            return [float(max_repeats * words[i]) if i in capped else level * weights[i] for i in range(len(words))]
        capped |= above


def split_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(units before the shard, units of the shard) by source: the walk from the root to ``shard``."""
    before, have, lo, hi = np.zeros_like(quotas), quotas.copy(), 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        units = int(have.sum())
        room = units * (mid - lo) // (hi - lo)
        left = _hypergeometric(np.random.default_rng([seed, lo, hi]), have, room)
        if shard < mid:
            have, hi = left, mid
        else:
            before, have, lo = before + left, have - left, mid
    return before, have


def _hypergeometric(rng: np.random.Generator, have: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric counts, source by source."""
    out, rest = np.zeros_like(have), int(have.sum())
    for i, n in enumerate(have.tolist()):
        rest -= n
        out[i] = got = int(rng.hypergeometric(n, rest, draws)) if n + rest and draws else 0
        draws -= got
    return out


def permuted(position: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size-1 (a Feistel network that walks its cycles back into range)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = position.astype("u8"), np.ones(len(position), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            x = (right + np.uint64((key * 4 + turn) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= size
    return out.astype("i8")


def sized(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One narrow row per document: key, source, size (words), order (hash)."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), size.alias("size"),
                       hash_order(F.lit(SEED), F.col(key)).alias("order"))


def source_targets(rows: DataFrame, weights: list[float], max_repeats: int = MAX_REPEATS) -> list[dict]:
    """One dict per source in code point order, null last: source, rows, words, target.

    ``weights`` repeat along the sources.  Together they share 100 % of all words.
    """
    found = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    words = [int(r["words"]) for r in found]
    wanted = targets(words, [weights[i % len(weights)] for i in range(len(found))], float(sum(words)), max_repeats)
    return [{"no": i, "source": r["source"], "n": int(r["n"]), "words": words[i], "target": wanted[i]}
            for i, r in enumerate(found)]


def draw(rows: DataFrame, sources: list[dict], block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``rows`` (of ``sized``) with source_size, target, taken and ``draws``: a (shard, pass) for
    each time that the mix takes the document."""
    spark = rows.sparkSession
    # as many ranges in a source as rows in a range: neither level outgrows a task
    table = spark.createDataFrame(
        [(s["no"], s["source"], math.isqrt(s["n"]) + 1, s["words"], s["target"],
          int(s["target"] // s["words"]) if s["words"] else 0) for s in sources],
        "no int, source string, ranges int, source_size long, target double, passes int")
    table = table.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    placed = rows.join(table, rows["source"].eqNullSafe(table["source"]), "left").drop(table["source"])
    # the hash is uniform: its leading digits cut each source into ranges of equal size, in order
    placed = placed.withColumn("range", F.floor(
        F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("ranges")))
    per_range = placed.groupBy("no", "range").agg(F.sum("size").alias("range_size"))
    up_to = Window.partitionBy("no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("no", "range", F.coalesce(F.sum("range_size").over(up_to), F.lit(0)).alias("offset"))
    within = Window.partitionBy("no", "range").orderBy("order", "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(offsets, ["no", "range"]).withColumn("before", F.col("before") + F.col("offset")))
    placed = placed.withColumn("block", F.floor(F.col("before") / block_words))
    units = _units(spark, sources, block_words, shard_blocks)
    partial = F.col("before") + F.col("size") / 2 <= F.col("rest")
    placed = placed.join(units, ["no", "block"], "left")
    draws = F.filter(F.coalesce("units", F.array().cast("array<struct<shard:int,pass:int>>")),
                     lambda u: (u["pass"] < F.col("passes")) | partial)
    return (placed.withColumn("draws", F.when(F.col("size") > 0, draws).otherwise(F.array()))
            .select("key", "source", "size", "order", "source_size", "target",
                    (F.col("size") * F.size("draws")).alias("taken"), "draws"))


def _units(spark, sources: list[dict], block_words: int, shard_blocks: int) -> DataFrame:
    """(no, block) -> the (shard, pass) of its units, by the splitting tree."""
    blocks = [-(-s["words"] // block_words) for s in sources]
    whole = [int(s["target"] // s["words"]) if s["words"] else 0 for s in sources]
    # a document may begin in the last block of the partial pass even if it isn't taken: it counts as a unit
    quotas = [w * b + (min(b, math.ceil((s["target"] - w * s["words"]) / block_words)) if b else 0)
              for s, w, b in zip(sources, whole, blocks, strict=True)]
    shards = max(1, -(-sum(quotas) // shard_blocks))
    names = ["no", "block", "shard", "pass"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(quotas, "i8")
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                before, have = split_quotas(total, shards, shard)
                for no in np.flatnonzero(have).tolist():
                    at = permuted(np.arange(before[no], before[no] + have[no]), quotas[no], no + 1)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, no, "i4")), pa.array(at % blocks[no]),
                         pa.array(np.full(n, shard, "i4")), pa.array((at // blocks[no]).astype("i4"))], names)

    made = spark.range(0, shards, 1, max(1, min(shards // 256, 4096))).mapInArrow(
        walk, "no int, block long, shard int, pass int")
    return made.groupBy("no", "block").agg(F.collect_list(F.struct("shard", "pass")).alias("units"))


def plan(docs: DataFrame, weights: list[float], text: str = "text", key: str = "doc_id", source: str = "source",
         max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document with its size, its source's target, and its draws."""
    rows = cut_lineage(sized(docs, text, key, source))  # narrow; whole texts are read once
    return draw(rows, source_targets(rows, weights, max_repeats), block_words)


def mix(docs: DataFrame, weights: list[float], text: str = "text", key: str = "doc_id", source: str = "source",
        max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard: str = "shard") -> DataFrame:
    """The mix: the columns of ``docs`` plus ``shard`` (which replaces one of that name); a row for each time that a document is taken.

    Rows of one shard stand together, in a hashed order.  A key that several rows share is drawn
    once for each of them, by the rows' places in the order.
    """
    drawn = plan(docs, weights, text, key, source, max_repeats, block_words)
    drawn = drawn.filter(F.size("draws") > 0).select("key", "source", "size", F.explode("draws").alias("draw"))
    # equal keys of one source and size are interchangeable: number them on both sides
    alike = ["key", "source", "size"]
    drawn = drawn.groupBy(*[F.col(c).alias(f"__d_{c}") for c in alike]).agg(F.collect_list("draw").alias("__all_draws"))
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    left = docs.withColumns({"__size": size, "__source": F.col(source).cast("string")})
    rank = F.row_number().over(Window.partitionBy(F.col(key), "__source", "__size").orderBy(F.sha2(text, 256)))
    many = F.count("*").over(Window.partitionBy(F.col(key), "__source", "__size"))
    left = left.withColumns({"__rank": rank - 1, "__many": many})
    both = left.join(drawn, left[key].eqNullSafe(drawn["__d_key"]) & left["__source"].eqNullSafe(drawn["__d_source"])
                     & (left["__size"] == drawn["__d_size"]))
    # the r-th of m alike rows gets the draws r, r + m, r + 2m, ...: m rows share out all draws evenly
    both = both.withColumn("__draw", F.explode(F.expr(
        "filter(transform(array_sort(__all_draws), (x, i) -> if(i % __many = __rank, x, null)), x -> x is not null)")))
    out = both.select(*[left[c] for c in docs.columns if c.lower() != shard.lower()], F.col("__draw.shard").alias(shard),
                      F.md5(F.concat_ws("|", F.lit(SEED), "__draw.pass", left[key].cast("string"))).alias("__at"))
    return out.repartition(F.col(shard)).sortWithinPartitions(shard, "__at").drop("__at")
