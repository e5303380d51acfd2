"""Encoders of code columns into numbers.

Null semantics follow the reference's pandas behaviour: a comparison with a
missing value is False (-> 0), never NULL.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c, token) -> Column:
    """1 if ``c == token`` else 0; null -> 0."""
    return F.coalesce(_c(c) == F.lit(token), F.lit(False)).cast("int")


def any_flag(cols_tokens) -> Column:
    """1 if any ``(column, token)`` pair matches, else 0 (disjunctive label)."""
    conds = [F.coalesce(_c(c) == F.lit(t), F.lit(False)) for c, t in cols_tokens]
    out = conds[0]
    for cond in conds[1:]:
        out = out | cond
    return out.cast("int")


def member_flag(c, values) -> Column:
    """1 if ``c`` is one of ``values`` else 0; null -> 0."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False)).cast("int")


def threshold_flag(c, threshold, op: str = ">") -> Column:
    """1 if ``c <op> threshold`` else 0; null -> 0."""
    col = _c(c)
    cond = {
        ">": col > threshold, ">=": col >= threshold,
        "<": col < threshold, "<=": col <= threshold,
    }[op]
    return F.coalesce(cond, F.lit(False)).cast("int")


def map_default(c, mapping: dict, default=None) -> Column:
    """Look ``c`` up in a small literal map; unknown codes and nulls give ``default``.

    The map is a literal inside the generated code, so this stays a narrow,
    shuffle-free projection however large the table is.
    """
    lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    looked = F.when(_c(c).isNull(), F.lit(None)).otherwise(F.try_element_at(lit_map, _c(c)))
    if default is None:
        return looked
    return F.coalesce(looked, F.lit(default))


def map_nullable(c, true_tokens=("TRUE", "1"), false_tokens=("FALSE", "0")) -> Column:
    """Mixed bool/string codes -> 1 / 0; anything else -> null."""
    s = F.upper(F.trim(_c(c).cast("string")))
    return (F.when(s.isin(list(true_tokens)), F.lit(1))
            .when(s.isin(list(false_tokens)), F.lit(0)))
