"""Every query of the catalogue gives the rows of its SQL."""

import datetime
import decimal

import pytest

from envlake.plans.queries import CATALOGUE

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, datetime.datetime):
        v = v.replace(tzinfo=None)
        return v.date().isoformat() if v.time() == datetime.time.min else v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float | decimal.Decimal):
        return f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query(spark, data, duck, name):
    query, sql = CATALOGUE[name]
    df = query(spark, data)
    found = duck.execute(sql)
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall())
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert got == want
