"""Numeric column builders used by the feature recipes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def square(c) -> Column:
    """c * c (exact for doubles, unlike a generic power)."""
    col = _c(c).cast("double")
    return col * col


def product(a, b) -> Column:
    return _c(a).cast("double") * _c(b).cast("double")


def bin_right_closed(c, edges, default=1.0) -> Column:
    """Index of the right-closed bin ``(edges[i], edges[i+1]]`` holding ``c``.

    Values outside ``(edges[0], edges[-1]]`` and nulls get ``default``.
    Spark's ``Bucketizer`` is left-closed, hence the explicit chain.
    """
    col = _c(c).cast("double")
    expr = None
    for i in range(len(edges) - 1):
        cond = (col > F.lit(float(edges[i]))) & (col <= F.lit(float(edges[i + 1])))
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return expr.otherwise(F.lit(float(default)))


def safe_ratio(num, den, fill=0.0) -> Column:
    """num / den where x/0 (inf) and 0/0 (NaN) become ``fill``."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")),
                      F.lit(float(fill)))


def row_sum(cols) -> Column:
    """Row-wise sum of the given columns, nulls skipped (0 when all are null)."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])


def abs_deviation(c, centre) -> Column:
    return F.abs(_c(c).cast("double") - F.lit(float(centre)))


def outside_range(c, lo, hi) -> Column:
    """1 if c < lo or c > hi else 0; null -> 0."""
    col = _c(c)
    return F.coalesce((col < F.lit(lo)) | (col > F.lit(hi)), F.lit(False)).cast("int")


def lenient_double(c, default=None) -> Column:
    """Parse as double; bad text (also a number with a type suffix, such as ``12d``) -> null (or ``default``)."""
    text = F.trim(_c(c).cast("string"))
    number = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"
    parsed = F.when(text.rlike(number), text.try_cast("double"))
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))
