"""Two-sided Kolmogorov-Smirnov p-value as a pure column expression.

Q(lam) is the survival function of the Kolmogorov distribution with
lam = D * sqrt(n*m/(n+m)).  Two series are used, each in the range where it
converges fast and without cancellation:

  lam >= 1.18:  Q = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lam^2)
  lam <  1.18:  Q = 1 - sqrt(2 pi)/lam * sum_{k>=1} exp(-(2k-1)^2 pi^2 / (8 lam^2))

The plain alternating series is wrong for tiny lam (it does not reach 1), so
the second (Jacobi theta) form is required there.

``ks_pvalue_exact`` counts lattice paths instead: under the null every order of the n + m values is equally
likely, an order is a path from (0, 0) to (n, m), and D stays below d if the path stays in a band.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: switch point between the two series and the number of terms
SWITCH = 1.18
TERMS = 100


def ks_lambda(d, n, m) -> Column:
    d, n, m = (F.col(x) if isinstance(x, str) else x for x in (d, n, m))
    n = n.cast("double")
    m = m.cast("double")
    return d * F.sqrt(n * m / (n + m))


def ks_pvalue(d, n, m) -> Column:
    lam = ks_lambda(d, n, m)
    ks = F.sequence(F.lit(1), F.lit(TERMS))
    alt = F.aggregate(
        ks, F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam))
    theta = F.aggregate(
        ks, F.lit(0.0),
        lambda acc, k: acc + F.exp(-((2 * k - 1) * (2 * k - 1)).cast("double")
                                   * F.lit(math.pi ** 2) / (F.lit(8.0) * lam * lam)))
    q = (F.when(lam.isNull(), F.lit(None))
         .when(lam <= 0, F.lit(1.0))
         .when(lam >= SWITCH, F.lit(2.0) * alt)
         .otherwise(F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * theta))
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


EXACT_SIZE = 10_000


def path_share(d: float, n: int, m: int) -> float:
    """The share of all paths from (0, 0) to (n, m) that touch |i / n - j / m| >= d, by their steps i + j.

    ``inside[i]`` is the share of the paths to (i, step - i) that have stayed below d: such a path came by i
    with probability i / step, or by j.
    """
    n, m = min(n, m), max(n, m)
    far = round(d * n * m)  # |i m - j n| is an integer
    if far <= 0:
        return 1.0
    inside = np.zeros(n + 2)  # one place in front, always 0
    inside[1] = 1.0
    for step in range(1, n + m + 1):
        # i m - (step - i) n lies within (-far, far)
        low = max(0, step - m, (step * n - far) // (n + m) + 1)
        high = min(n, step, -((-step * n - far) // (n + m)) - 1)
        i = np.arange(low, high + 1)
        made = inside[i] * (i / step) + inside[i + 1] * ((step - i) / step)
        inside[:] = 0.0
        inside[i + 1] = made
    return float(min(1.0, max(0.0, 1.0 - inside[n + 1])))


def ks_pvalue_exact(d, n, m) -> Column:
    """P(D >= d) of samples of n and m values, exactly; null where a sample is empty or holds over EXACT_SIZE values."""
    def shares(ds: pd.Series, ns: pd.Series, ms: pd.Series) -> pd.Series:
        return pd.Series([path_share(a, int(b), int(c)) if pd.notna(a) and 0 < b <= EXACT_SIZE and 0 < c <= EXACT_SIZE else None
                          for a, b, c in zip(ds, ns, ms, strict=True)], dtype="float64")

    return F.pandas_udf(shares, "double")(*[F.col(x) if isinstance(x, str) else x for x in (d, n, m)])
