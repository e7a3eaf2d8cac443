"""Cases that show only in larger tables or on a cluster, made small."""

import os
import re
import subprocess
import sys

import pytest

from fedspark.plans import catalog, web, webstand
from fedspark.sources import api
from fedspark.sources.filters import Predicate


def tables(spark, folder, **rows):
    for name, df in rows.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_lateral_limit_keeps_its_order(spark, tmp_path):
    """Of 40 orders each the two dearest, whatever order the rows come in."""
    customer = spark.range(50).selectExpr("id AS c_custkey")
    orders = spark.range(2000).selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "CAST(id * 7919 % 2003 AS DOUBLE) AS o_totalprice").repartition(8)
    df = catalog.queries()["join_lateral"](spark, tables(spark, tmp_path, customer=customer, orders=orders))
    window = re.search(r"row_number\(\) windowspecdefinition\((.*?), specifiedwindowframe", df._jdf.queryExecution().optimizedPlan().toString())
    assert "o_totalprice" in window[1] and "DESC" in window[1]
    dear = lambda c: sorted(range(c, 2000, 50), key=lambda i: (-(i * 7919 % 2003), i))[:2]
    assert sorted(map(tuple, df.collect())) == sorted((c, o) for c in range(50) for o in dear(c))


def test_rows_are_found_before_any_is_changed(spark, tmp_path):
    """Deleting while pages are read by offset would skip rows of later pages."""
    supplier = spark.range(1, 2401).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name", "CAST(id % 25 AS INT) AS s_nationkey", "CAST(id AS DOUBLE) AS s_acctbal")
    region = spark.createDataFrame([(0, "HERE")], "r_regionkey int, r_name string")
    engine, db, s = web._issues(spark, tables(spark, tmp_path, supplier=supplier, region=region))
    engine.sql(f"DELETE FROM {db}.issues WHERE s_suppkey % 100 = 7")
    methods = [method for method, _, _ in s.asked]
    assert methods.count("DELETE") == 24 and "DELETE" not in methods[: len(methods) - 24]
    assert sorted(r["s_suppkey"] for r in s.tables["issues"]) == [i for i in range(1, 2401) if i % 100 != 7]


CLUSTER = """
import sys
from pyspark.sql import SparkSession
from fedspark.plans import catalog
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "700m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
for name in ("scan_jdbc", "dml_jdbc_update", "dml_jdbc_delete"):
    df = catalog.queries()[name](spark, sys.argv[2])
    print("ROWS", df.count(), sorted(map(tuple, df.repartition(2).collect())))
"""


def test_executors_reach_the_database(sf, tmp_path):
    """Executors are other processes: they cannot see a database inside the driver."""
    env = {**os.environ, "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable, "SPARK_WORKER_DIR": str(tmp_path / "worker")}
    done = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path / "shared"), sf], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=150)
    rows = [r for r in done.stdout.splitlines() if r.startswith("ROWS")]
    assert [r.split()[1] for r in rows] == ["5", "25", "15"], done.stderr[-2000:]
    assert rows[1].count("'X'") == 5


def stood(n):
    """A service with ``n`` rows, and how often a row was looked at for a condition."""
    rows = [{"k": i, "name": f"n{i % 7}", "sys_id": str(i)} for i in range(n)]
    return webstand.Stand("127.0.0.1", {"t": rows}, {"t": "k"})


def looked(monkeypatch):
    seen, plain = [], webstand._test
    monkeypatch.setattr(webstand, "_test", lambda *a: seen.append(1) or plain(*a))
    return seen


def read(reader):
    return [r["k"] for run in reader.partitions() for page in run.pages for r in reader.api.read(page)]


def test_many_pages_are_few_tasks_and_one_search(monkeypatch):
    s, seen = stood(4000), looked(monkeypatch)
    reader = api.ApiReader(api.ServiceNow({"base": s.uri("http"), "table": "t", "page_size": 40}), None)
    reader.predicates = [Predicate("k", ">=", 100)]
    assert len(reader.partitions()) <= api.TASKS
    assert sorted(read(reader), key=int) == list(range(100, 4000))
    assert len(seen) == 2 * 4000  # the number of rows, and the rows in order


def test_groups_and_chains_are_found_once_and_pages_can_be_had_again(monkeypatch):
    s, seen = stood(1000), looked(monkeypatch)
    site = api.Salesforce({"base": s.uri("http"), "table": "t"})
    asked = site.request([Predicate("k", ">=", 100)], ["k"], 0, 1000)
    first = site.send(asked)
    again = site.following(first, asked, 40)
    assert site.rows(site.send(again)) == site.rows(site.send(again)) == [{"k": i} for i in range(140, 180)]
    rows = site.aggregate([Predicate("k", ">=", 100)], ["k"], [("count", None, "n")])
    assert rows == [[i, 1] for i in range(100, 1000)] and len(seen) == 1000


def test_endpoint_rows_are_searched_once_for_all_pages():
    s = stood(2000)
    site = api.Rest({"base": s.uri("http"), "table": "rows/t", "data_path": "data.items", "paging": "offset", "page_size": 30})
    found = [s._rest("GET", ["rows", "t"], {"name": "n3", "limit": "30", "offset": str(at)}, None) for at in (0, 30)]
    assert len(s._found) == 1 and [len(f["data"]["items"]) for f in found] == [30, 30]
    reader = api.ApiReader(site, None)
    reader.predicates = [Predicate("name", "=", "n3")]
    assert read(reader) == list(range(3, 2000, 7))
    s._change("t", "DELETE", "3", None)  # what was found before is not given again
    assert read(reader) == list(range(10, 2000, 7))


@pytest.mark.parametrize("n", [0, 1, 29, 30, 31, 119, 120, 121, 400])
@pytest.mark.parametrize("paging", ["offset", "page"])
def test_strands_have_every_row_once(n, paging):
    s = stood(n)
    options = {"base": s.uri("http"), "table": "rows/t", "data_path": "data.items", "paging": paging, "page_size": 30, "strands": 4}
    site = api.Rest(options)
    if paging == "page":  # the stand knows offsets only
        plain = site.send
        site.send = lambda r: plain({**r, "query": {"limit": r["query"]["limit"], "offset": (int(r["query"]["page"]) - 1) * 30}})
    reader = api.ApiReader(site, None)
    assert len(reader.partitions()) == 4 and sorted(read(reader)) == list(range(n))


def test_changes_of_many_rows_go_by_an_index():
    s = stood(500)
    for k in range(0, 500, 2):
        s._change("t", "DELETE", str(k), None)
    s._change("t", "PATCH", "7", {"name": "x"})
    s._change("t", "POST", None, {"k": 900, "name": "y"})
    s._change("t", "DELETE", "900", None)
    s._change("t", "PATCH", "9", {"k": 901})
    s._change("t", "DELETE", "901", None)
    assert [r["k"] for r in s.tables["t"]] == [k for k in range(1, 500, 2) if k != 9] and s.tables["t"][3]["name"] == "x"
