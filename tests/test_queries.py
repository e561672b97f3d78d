"""Every core query against its SQL on the smallest tables; the others against their determinism."""

import math
import os

import duckdb
import pytest

from sieveline.plans import catalog

SF = os.environ.get("SIEVELINE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v if v is None or isinstance(v, (int, bool)) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_against_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(map(norm, r))) for r in df.select(*cols).collect())
    res = con.execute(catalog.ORACLE[name])
    at = [[c[0] for c in res.description].index(c) for c in cols]
    assert len(res.description) == len(cols)
    want = sorted(repr(tuple(norm(r[i]) for i in at)) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_same_rows_again(spark, name):
    a, b = (sorted(map(repr, catalog.QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert a == b


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
