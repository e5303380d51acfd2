"""Every registered query with a SQL oracle equals DuckDB on the sf0.001 tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tessera.sources.tables import TABLES

ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_key_is_registered():
    assert set(ORACLE) <= set(E.queries())
    assert len(E.queries()) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"batch", "feature", "statistic", "p_value", "drifted"} <= set(df.columns)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    res = con.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    orows = sorted((tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert srows == orows
