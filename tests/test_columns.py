"""A stand-in's rows as columns give the answers that rows as dicts give, and what reads them stays small."""

import json
import threading

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException

from fedspark.plans import columns, web, webstand
from fedspark.plans.columns import Columns
from fedspark.sources import api
from fedspark.sources.filters import Predicate

ROWS = [{"k": i, "name": None if i % 11 == 0 else f'n{i % 7}", "%s\n', "x": i % 13 / 7, "n": None if i % 5 == 0 else i % 3, "b": i % 2 == 0, "sys_id": str(i)} for i in range(2500)]


def both():
    return [webstand.Stand("127.0.0.1", {"t": rows}, {"t": "k"}) for rows in ([dict(r) for r in ROWS], Columns(pa.Table.from_pylist(ROWS)))]


def told(stand, method, path, q, body=None):
    got = stand.answer(method, path.split("/"), q, body)[1]
    got = json.loads(got) if isinstance(got, bytes) else json.loads(json.dumps(got))
    if "group" in str(q).lower():  # groups come in any order
        rows = next(v for v in got.values() if isinstance(v, list))
        rows.sort(key=json.dumps)
    return got


@pytest.mark.parametrize(
    "path, q",
    [
        ("rows/t", {"limit": "30", "offset": "1010"}),
        ("rows/t", {"limit": "30", "offset": "2490", "n": "2"}),
        ("rows/t", {"name": "None", "other": "1", "limit": "9"}),
        ("rows/t", {"mode": "cursor", "cursor": "2480"}),
        ("rows/t", {"mode": "cursor", "cursor": "1000"}),
        ("api/now/table/t", {"sysparm_query": "kIN5,77,1200^ORDERBYDESCsys_id", "sysparm_fields": "name,k"}),
        ("api/now/table/t", {"sysparm_query": "nISEMPTY^nameLIKE3^ORDERBYDESCn^ORDERBYDESCname^ORDERBYsys_id", "sysparm_offset": "3"}),
        ("api/now/table/t", {"sysparm_query": "n!=1^x>=1^ORDERBYname^ORDERBYDESCn", "sysparm_limit": "20"}),
        ("api/now/stats/t", {"sysparm_query": "k>=100", "sysparm_group_by": "n", "sysparm_min_fields": "name", "sysparm_max_fields": "k"}),
        ("api/now/stats/t", {"sysparm_query": "k>=100", "sysparm_sum_fields": "x", "sysparm_group_by": "name"}),
        ("api/now/stats/t", {"sysparm_query": "k>9999", "sysparm_max_fields": "k"}),
        ("services/data/v59.0/query", {"q": "SELECT k, name FROM t WHERE name LIKE 'n3%' AND k < 2000 ORDER BY k desc LIMIT 70"}),
        ("services/data/v59.0/query", {"q": "SELECT name, COUNT() m0, MAX(k) m1, COUNT(n) m2 FROM t WHERE k >= 30 GROUP BY name"}),
        ("services/data/v59.0/sobjects/t/describe", {}),
    ],
)
def test_columns_answer_as_rows_do(path, q):
    plain, packed = both()
    assert told(plain, "GET", path, q) == told(packed, "GET", path, q)
    assert isinstance(packed._tables["t"], Columns)
    for stand in (plain, packed):  # a change turns columns into rows
        stand._change("t", "PATCH", "1011", {"name": "z"})
        stand._change("t", "DELETE", "1500", None)
    assert told(plain, "GET", path, q) == told(packed, "GET", path, q)
    assert plain.tables == packed.tables


def test_blocks_beyond_what_is_kept_are_made_again(monkeypatch):
    monkeypatch.setattr(columns, "KEPT", 1)
    rows = Columns(pa.Table.from_pylist(ROWS))
    assert json.loads(f"[{rows.json(0, 2500)}]") == ROWS and json.loads(f"[{rows.json(5, 3)}]") == ROWS[5:8]
    assert rows.json(2500, 10) == "" and len(columns._TEXTS.held) == 1


def test_rows_travel_as_batches_with_their_types(spark):
    _, packed = both()
    site = api.Rest({"base": packed.uri("http"), "table": "rows/t", "data_path": "data.items", "paging": "offset", "page_size": 100})
    reader = api.ApiReader(site, site.discover())
    (run,) = reader.partitions()
    got = list(reader.read(run))
    assert all(isinstance(b, pa.RecordBatch) for b in got) and sum(b.num_rows for b in got) == 2500
    assert pa.Table.from_batches(got).select(list(ROWS[0])).to_pylist() == ROWS
    odd = [{"a": 1, "b": "x"}, {"a": "7", "b": 5}, {"a": None}, {"a": 2.0, "b": True}]
    kinds = reader.schema.fields
    text, whole = next(f for f in kinds if f.name == "name"), next(f for f in kinds if f.name == "k")
    assert reader._values([{"name": r.get("b")} for r in odd], text) == ["x", "5", None, "True"]
    assert reader._values([{"k": r.get("a")} for r in odd], whole) == [1, 7, None, 2]


def test_keys_of_a_join_leave_the_rows_as_columns(spark, sf):
    engine, db, s = web._tickets(spark, sf, ("customer", "c_custkey"))
    few = spark.read.parquet(f"{sf}/nation.parquet").where("n_regionkey = 2")
    engine.join_reduced(few, "n_nationkey", db, "customer", "c_nationkey").collect()
    assert isinstance(s._tables["customer"], Columns)


def test_groups_are_read_by_a_task_and_not_while_planning(spark, sf):
    engine, db, s = web._objects(spark, sf)
    df = engine.sql(f"SELECT c_name, count(*) AS n, max(c_custkey) AS last FROM {db}.customer WHERE c_acctbal > 0 GROUP BY c_name")
    asked = lambda: [p for _, p, q in s.asked if "GROUP BY" in q.get("q", "") or "/more/" in p]
    assert not asked()
    assert df.count() > s.most and len(asked()) >= 3


def test_no_answer_of_a_chain_is_larger_than_a_page(spark, sf, monkeypatch):
    sizes, plain = [], webstand.Stand._rest
    monkeypatch.setattr(webstand.Stand, "_rest", lambda *a: sizes.append(len(json.loads(got := plain(*a))["data"]["items"])) or got)
    assert web.web_rest_cursor(spark, sf).count() == sum(sizes[1:]) and max(sizes) <= webstand.Stand.most


def test_a_request_is_taken_when_it_is_whole():
    held = bytearray(b"POST /a?b=1 HTTP/1.1\r\nContent-Type: application/json\r\ncontent-length: 4\r\n\r\n[1")
    assert webstand._whole(held) is None
    held += b"2]GET /c HTTP/1.1\r\n\r\n"
    assert webstand._whole(held) == ("POST", "/a?b=1", True, b"[12]") and webstand._whole(held) == ("GET", "/c", False, b"") and not held


def test_a_filter_that_the_service_lacks_is_grouped_here(monkeypatch):
    monkeypatch.setattr(api.filters, "soql", lambda p: None)
    site = api.Salesforce({"base": "http://127.0.0.1:9", "table": "t"})
    assert site.aggregate_request([Predicate("k", "=", 1)], ["k"], []) is None and site.aggregate([Predicate("k", "=", 1)], ["k"], []) is None


def test_a_condition_is_put_to_each_distinct_value_once(monkeypatch):
    seen, plain = [], webstand._test
    monkeypatch.setattr(webstand, "_test", lambda *a: seen.append(1) or plain(*a))
    _, packed = both()
    assert told(packed, "GET", "api/now/table/t", {"sysparm_query": "n=2^x<1^ORDERBYsys_id", "sysparm_limit": "3"})["result"][0]["sys_id"] == min(r["sys_id"] for r in ROWS if r["n"] == 2 and r["x"] < 1)
    assert len(seen) == 4 + 13  # n and x have so many values
    rows, q = packed._tables["t"], {"n": "2", "limit": "30"}
    assert [told(packed, "GET", "rows/t", {**q, "offset": str(at)})["data"]["items"] for at in (0, 30)] == [[r for r in ROWS if r["n"] == 2][at : at + 30] for at in (0, 30)]
    assert packed._tables["t"] is rows


def test_keys_from_sql_leave_the_rows_as_columns(spark, sf):
    engine, db, s = web._tickets(spark, sf, ("customer", "c_custkey"))
    files = webstand.name("files")
    engine.attach(files, sf, ["nation"])
    n = engine.sql(f"SELECT c_custkey, n_name FROM {db}.customer JOIN {files}.nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2").count()
    pages = [q for _, p, q in s.asked if p.endswith("/table/customer") and "c_nationkeyIN" in q["sysparm_query"]]
    assert isinstance(s._tables["customer"], Columns) and len(pages) == -(-n // s.most)


@pytest.mark.parametrize("pinned", [True, False])
def test_rows_are_loaded_while_the_engine_is_set_up(spark, sf, monkeypatch, pinned):
    began, seen, load, engine = threading.Event(), [], web.stand, web.Engine
    monkeypatch.setattr(web, "stand", lambda *a, **k: began.set() or load(*a, **k))
    monkeypatch.setattr(web, "Engine", lambda s: seen.append(began.wait(10)) or engine(s))
    if not pinned:
        monkeypatch.setattr(web, "inheritable_thread_target", lambda s: s)
    want = spark.read.parquet(f"{sf}/customer.parquet").where("c_mktsegment = 'BUILDING' AND c_acctbal > 1000 AND c_name LIKE '%1%'").select("c_custkey", "c_acctbal")
    assert sorted(web.web_rest_filters(spark, sf).collect()) == sorted(want.collect()) and seen == [True]
    with pytest.raises(AnalysisException):
        web._rest(spark, f"{sf}/none")
