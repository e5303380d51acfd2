"""Exact small-sample KS against the enumeration of all orders."""
import itertools
import math

import pytest

from tessera.functions import kolmogorov as K
from tessera.operators import drift


def enumerated(n, m):
    """{D as n m D: share of the orders with at least that D}."""
    found = []
    for places in itertools.combinations(range(n + m), n):
        i = j = top = 0
        for at in range(n + m):
            if at in places:
                i += 1
            else:
                j += 1
            top = max(top, abs(i * m - j * n))
        found.append(top)
    return {d: sum(f >= d for f in found) / len(found) for d in set(found)}


@pytest.mark.parametrize("n", range(1, 9))
def test_equals_enumeration(n):
    for m in range(1, 9):
        for d, share in enumerated(n, m).items():
            assert K.path_share(d / (n * m), n, m) == pytest.approx(share, abs=1e-12)


def test_limits():
    assert K.path_share(0.0, 5, 7) == 1.0 and K.path_share(1.0, 6, 6) == pytest.approx(2 / math.comb(12, 6))
    # large samples approach the limit distribution
    d = 0.03
    lam = d * math.sqrt(2000 / 2)
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 100))
    assert K.path_share(d, 2000, 2000) == pytest.approx(limit, abs=0.01)


def test_drift_with_exact_values(spark):
    ref = spark.createDataFrame([("a", float(i)) for i in range(6)] + [("b", 1.0)], "feature string, value double")
    bat = spark.createDataFrame([(1, "a", float(i) + 3.5) for i in range(7)] + [(1, "b", 2.0), (2, "a", None)], "batch int, feature string, value double")
    got = {(r.batch, r.feature): (r.statistic, r.p_value) for r in drift.ks_drift(ref, bat, exact=True).collect()}
    want = enumerated(6, 7)
    assert got[1, "a"][1] == pytest.approx(want[round(got[1, "a"][0] * 42)]) and got[1, "b"] == (1.0, 1.0)
    big = spark.createDataFrame([(0.2, 10_001, 5), (0.2, 0, 5), (None, 3, 3)], "d double, n long, m long")
    assert {r[0] for r in big.select(K.ks_pvalue_exact("d", "n", "m")).collect()} == {None}
