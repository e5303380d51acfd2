"""Schema-intersecting bag union (UNION ALL by name)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def common_columns(frames: list[DataFrame]) -> list[str]:
    common = set(frames[0].columns)
    for f in frames[1:]:
        common &= set(f.columns)
    return sorted(common)


def union_common(frames: list[DataFrame], fill_missing: bool = False) -> DataFrame:
    """Concatenate rows of all frames.

    Default: keep only the columns every input has, sorted by name.  With
    ``fill_missing`` keep the union of columns (sorted), missing ones null.
    Inputs that are ``None`` (optional sources not found) are skipped.
    """
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("no input frame")
    if fill_missing:
        cols = sorted(set().union(*[set(f.columns) for f in frames]))
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return out.select(*cols)
    cols = common_columns(frames)
    return reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames])
