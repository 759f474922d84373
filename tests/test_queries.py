"""Every registered query against its SQL on the smallest tables."""

import decimal

import duckdb
import pytest

from chainframe import plans
from chainframe.fixtures import BASE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return round(v, 6) if isinstance(v, float) else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, oracle, name):
    df = plans.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = oracle.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in found.fetchall()]
    assert ordered(got) == ordered(want)
