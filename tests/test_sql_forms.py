"""QUALIFY through the engine, and sliced as-of joins with awkward rows."""

import random

import duckdb
import pytest

from fedspark import qualify
from fedspark.engine import Engine
from fedspark.operators import asof_join

QUERIES = [
    "SELECT k, v FROM rows_q QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC) = 1 ORDER BY k LIMIT 3",
    "SELECT k, v, rank() OVER (PARTITION BY k ORDER BY v) AS r FROM rows_q WHERE v > 2 QUALIFY r <= 2",
    "SELECT DISTINCT k FROM rows_q QUALIFY count(*) OVER (PARTITION BY k) > 3",
    "SELECT k, sum(v) AS s FROM rows_q GROUP BY k QUALIFY rank() OVER (ORDER BY sum(v) DESC) <= 2",
    "WITH t AS (SELECT * FROM rows_q QUALIFY ntile(2) OVER (ORDER BY v) = 1) SELECT count(*) AS n FROM t",
    "SELECT k FROM rows_q QUALIFY v = max(v) OVER () UNION ALL SELECT v AS k FROM (SELECT k, v FROM rows_q QUALIFY lag(v) OVER (ORDER BY v) IS NULL)",
    "SELECT k, 'QUALIFY (x' AS word FROM rows_q WINDOW w AS (PARTITION BY k ORDER BY v) QUALIFY row_number() OVER w = 2",
]


@pytest.fixture(scope="module")
def rows():
    return [(i % 5, i * 7 % 23) for i in range(20)]


@pytest.mark.parametrize("text", QUERIES)
def test_qualify(spark, rows, text):
    spark.createDataFrame(rows, "k long, v long").createOrReplaceTempView("rows_q")
    con = duckdb.connect()
    con.execute("CREATE TABLE rows_q (k BIGINT, v BIGINT)")
    con.executemany("INSERT INTO rows_q VALUES (?, ?)", rows)
    want = con.sql(text)
    got = Engine(spark).sql(text)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_qualify_as_a_name_stays():
    for text in ("SELECT qualify FROM t", "SELECT t.qualify, a AS qualify FROM t", "SELECT 'QUALIFY x' FROM t -- QUALIFY y"):
        assert qualify.rewrite(text) == text


@pytest.mark.parametrize("width", [None, 1, 10, 1000])
def test_asof_slices(spark, width):
    r = random.Random(5)
    # one hot group, gaps of many slices, nulls in keys and times, ties
    group = lambda: r.choice([1, 1, 1, 2, 3, None])
    time = lambda: r.choice([None, r.randrange(-50, 50), r.randrange(0, 5000)])
    left = [(i, group(), time()) for i in range(150)]
    right = [(group(), time(), r.choice([None, i]), i) for i in range(60)] + [(2, 7, 100, 100), (2, 7, 101, 101)]
    df = asof_join(spark.createDataFrame(left, "id long, g long, t long"), spark.createDataFrame(right, "g long, t long, p long, o long"), "t", ["g"], ["p"], tie="o", width=width)
    want = []
    for i, g, t in left:
        fits = [x for x in right if None not in (g, t, x[0], x[1]) and x[0] == g and x[1] <= t]
        want.append((i, g, t, max(fits, key=lambda x: (x[1], x[3]))[2] if fits else None))
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
