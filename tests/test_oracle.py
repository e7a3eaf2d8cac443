"""Every registered query of the engine against its SQL on the same files."""

import datetime
import decimal
import math

import duckdb
import pytest

from fedspark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def ordered(names, rows):
    by = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in by], sorted((tuple(plain(r[i]) for i in by) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got[0]
        return
    out = duck.sql(sql)
    assert got == ordered(out.columns, out.fetchall())
