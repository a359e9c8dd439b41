"""Queries of the library against their SQL, run by DuckDB on the same tables."""

import math

import duckdb
import pytest

from quoin.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if v is None or v != v:
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(float(v), 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    sql = registry.oracle_sql().get(name)
    rows = got.collect()
    assert rows
    if sql:
        want = duck.sql(sql)
        names = sorted(want.columns)
        assert sorted(got.columns) == names
        place = [want.columns.index(n) for n in names]
        a = sorted([tuple(value(r[n]) for n in names) for r in rows], key=str)
        b = sorted([tuple(value(r[i]) for i in place) for r in want.fetchall()], key=str)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert all(p == q or isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, abs_tol=2e-3) for p, q in zip(x, y)), (x, y)
