"""Deterministic per-row randomness from hashed ids.

``rand(seed)`` depends on partitioning; these do not, so a result is the same
on 8 threads or 1,000 executors, and a SQL engine can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42
_TWO_32 = 4294967296.0


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_hex(id_col, tag: str = "", seed: int = DEFAULT_SEED) -> Column:
    """md5 hex of ``'<seed>|<tag>|<id>'`` (or ``'<seed>|<id>'`` without a tag)."""
    parts = [F.lit(str(seed))]
    if tag:
        parts.append(F.lit(tag))
    parts.append(_as_col(id_col).cast("string"))
    return F.md5(F.concat_ws("|", *parts))


def hash_u(id_col, tag: str = "", seed: int = DEFAULT_SEED) -> Column:
    """Uniform double in [0, 1) from the first 8 hex digits of ``hash_hex``."""
    h = hash_hex(id_col, tag, seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_32)


def hash_bucket(id_col, buckets: int, tag: str = "", seed: int = DEFAULT_SEED) -> Column:
    """Bucket in [0, buckets) that is monotone in ``hash_hex`` order."""
    return F.floor(hash_u(id_col, tag, seed) * F.lit(buckets)).cast("int")
