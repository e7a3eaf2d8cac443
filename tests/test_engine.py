import asyncio
import os

import pytest
from pyspark.sql import types as T

from fedspark import errors, schema
from fedspark.dbapi import AsyncConnection, Connection
from fedspark.engine import Engine, file_format
from fedspark.sources import auth, filters
from fedspark.sources.api import Salesforce
from fedspark.sources.excel import workbook
from fedspark.sources.filters import Predicate
from fedspark.sources.http import Client, Retry

from .fakes import ACCOUNTS, INCIDENTS, ISSUES, USERS, Server


@pytest.fixture(scope="module")
def server():
    with Server() as s:
        yield s


@pytest.fixture(scope="module")
def engine(spark, server, tmp_path_factory):
    e = Engine(spark)
    e.attach("web", server.base, insecure=True, retry_base=0.01)
    e.add_table("web", "users", data_path="data.items", paging="offset", page_size=10)
    e.add_table("web", "cursor", alias="chained", data_path="data", paging="cursor", page_size=10)
    host = server.base.removeprefix("http://")
    e.attach("sn", f"servicenow://{host}", insecure=True, username="u", password="p", page_size=25, tables=["incident", "sys_attachment_content"])
    e.attach("sf", f"salesforce://{host}", insecure=True, token="t", tables=["Account"])
    e.attach("ji", f"jira://{host}", insecure=True, api_key="k", tables=["issues", "project"])
    d = tmp_path_factory.mktemp("files")
    (d / "items.csv").write_text("id,name,value\n1,a,100\n2,b,200\n3,c,300\n")
    (d / "list.json").write_text('[{"id": 1, "x": {"y": 2}}, {"id": 2, "x": {"y": 3}}]')
    (d / "book.xlsx").write_bytes(workbook(["id", "name", "ok"], [(1, "x<y", True), (2, None, False)]))
    e.attach("files", str(d))
    return e


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rest_pages_filters_and_residuals(engine, server):
    server.asked()
    assert rows(engine.sql("SELECT id FROM web.users WHERE role = 'admin' AND id > 10")) == [(i,) for i in range(12, 26, 3)]
    assert all(q.get("role") == "admin" for _, p, q, _, _ in server.asked() if p == "/users")
    assert rows(engine.sql("SELECT id FROM web.users WHERE role = 'admin' OR name LIKE '%5'")) == [(u["id"],) for u in USERS if u["role"] == "admin" or u["name"].endswith("5")]
    assert engine.sql("SELECT * FROM web.chained").count() == 25
    assert rows(engine.sql("SELECT u.at.city, count(*) FROM web.users u GROUP BY 1")) == [("c0", 6), ("c1", 7), ("c2", 6), ("c3", 6)]
    server.http.refuse = 2
    assert engine.sql("SELECT id FROM web.users LIMIT 3").count() == 3


def test_servicenow_pushes_columns_filters_and_pages(engine, server):
    server.asked()
    got = rows(engine.sql("SELECT number FROM sn.incident WHERE priority = 1 AND active = false"))
    assert got == sorted((r["number"],) for r in INCIDENTS if r["priority"] == 1 and not r["active"])
    asked = [q for _, p, q, _, h in server.asked() if p == "/api/now/table/incident"]
    assert all("priority=1" in q["sysparm_query"] and set(q["sysparm_fields"].split(",")) == {"number", "priority", "active"} for q in asked)
    assert engine.sql("SELECT * FROM sn.incident").count() == 60
    assert len([1 for _, p, _, _, _ in server.asked() if p == "/api/now/table/incident"]) == 3
    assert engine.list_tables("sn") == ["incident", "problem"]
    assert rows(engine.sql("SELECT content FROM sn.sys_attachment_content WHERE sys_id = 'x'")) == [(b"\x00bytes",)]
    assert engine.last_report.steps[0]["step"] == "analyse"


def test_credentials_stay_out_of_options(engine, server, spark):
    server.asked()
    engine.sql("SELECT count(*) FROM sn.incident").collect()
    assert {h.get("Authorization") for *_, h in server.asked()} == {"Basic dTpw"}
    assert "Basic" not in str(spark.sql("DESCRIBE EXTENDED sn.incident").collect()) and "password" not in str(engine.tables_of)


def test_salesforce(engine, server):
    assert rows(engine.sql("SELECT Id FROM sf.Account WHERE AnnualRevenue > 900 AND Type = 'Customer'")) == [("A11",)]
    assert engine.sql('SELECT "Name" FROM sf."Account"').count() == len(ACCOUNTS)
    assert rows(engine.sql("SELECT Name FROM sf.Account WHERE Name LIKE 'Acme 1%'")) == [("Acme 1",), ("Acme 10",), ("Acme 11",), ("Acme 12",)]
    server.asked()
    assert engine.sql("SELECT Name FROM sf.Account LIMIT 2").count() == 2
    assert any("LIMIT 2" in q.get("q", "") and "SELECT Name FROM" in q["q"] for _, _, q, _, _ in server.asked())
    api = Salesforce({"base": server.base, "table": "Account"})
    assert api.bulk_insert(["Name"], "Name\nx\n", poll=0)["state"] == "JobComplete"


def test_jira(engine, server):
    assert engine.sql("SELECT key FROM ji.issues").count() == 150
    server.asked()
    assert engine.sql("SELECT key FROM ji.issues WHERE points > 140").count() == 10
    assert all("points > 140" in b["jql"] for _, p, _, b, _ in server.asked() if p.endswith("search") and b)
    assert rows(engine.sql("SELECT status.name, count(*) FROM ji.issues GROUP BY 1")) == [("Done", 75), ("Open", 75)]
    assert rows(engine.sql("SELECT name FROM ji.project")) == [("Proj",), ("Quux",)]
    assert len(ISSUES) == 150


def test_aggregates_at_the_source_and_here(engine):
    want = {}
    for r in INCIDENTS:
        if r["active"]:
            n, s = want.get(r["caller"], (0, 0.0))
            want[r["caller"]] = n + 1, s + r["priority"]
    got = engine.aggregate("sn", "incident", ["caller"], [("count", None, "n"), ("sum", "priority", "s")], [Predicate("active", "=", True)])
    assert engine.last_report.steps[0]["details"]["pushed"] and rows(got) == sorted((k, *v) for k, v in want.items())
    here = engine.aggregate("web", "users", ["role"], [("count", None, "n"), ("max", "id", "m")])
    assert not engine.last_report.steps[0]["details"]["pushed"] and rows(here) == [("admin", 8, 24.0), ("guest", 17, 25.0)]


def test_joins_across_sources(engine, server, spark):
    got = rows(engine.sql("SELECT u.id, i.name FROM web.users u JOIN files.items i ON u.id = i.id WHERE i.value > 150"))
    assert got == [(2, "b"), (3, "c")]
    server.asked()
    few = spark.createDataFrame([("user1",), ("user3",)], "who string")
    out = engine.join_reduced(few, "who", "sn", "incident", "caller")
    assert out.count() == sum(r["caller"] in ("user1", "user3") for r in INCIDENTS)
    assert any("callerINuser" in q.get("sysparm_query", "") for _, _, q, _, _ in server.asked())


def test_joins_reduced_from_sql(engine, server, spark, tmp_path):
    """Keys of files are sent where the join drops all other rows; never where those are needed."""
    spark.createDataFrame([("user1", 1), ("user3", 2), ("user3", 3), (None, 4)], "who string, n int").write.parquet(f"{tmp_path}/few.parquet")
    spark.createDataFrame(INCIDENTS).createOrReplaceTempView("plain_incidents")
    few = f"parquet.`{tmp_path}/few.parquet`"
    forms = [  # query, whether keys are sent
        ("SELECT number, n FROM {sn} i JOIN {few} f ON i.caller = f.who", True),
        ("SELECT number, n FROM {few} f LEFT JOIN {sn} i ON f.who = i.caller AND f.n < 3", True),
        ("SELECT number FROM {sn} i WHERE caller IN (SELECT who FROM {few})", True),
        ("SELECT number FROM {sn} i WHERE EXISTS (SELECT 1 FROM {few} f WHERE f.who = i.caller AND n > 1)", True),
        ("SELECT number, n FROM {sn} i LEFT JOIN {few} f ON i.caller = f.who", False),
        ("SELECT number, n FROM {sn} i FULL JOIN {few} f ON i.caller = f.who", False),
        ("SELECT number FROM {sn} i LEFT ANTI JOIN {few} f ON i.caller = f.who", False),
        ("SELECT number FROM {sn} WHERE caller NOT IN (SELECT who FROM {few} WHERE who IS NOT NULL)", False),
        ("SELECT i.number, j.number AS other FROM {sn} i JOIN {few} f ON i.caller = f.who JOIN {sn} j ON j.priority = f.n", False),
        ("SELECT number, (SELECT max(priority) FROM {sn}) AS top FROM {sn} i JOIN {few} f ON i.caller = f.who", False),
        ("WITH c AS (SELECT * FROM {sn}) SELECT a.number FROM c a JOIN {few} f ON a.caller = f.who UNION ALL SELECT number FROM c", False),
        ("SELECT number, n FROM {sn} i JOIN (SELECT * FROM {few} WHERE rand() < 2) f ON i.caller = f.who", False),
        ("SELECT number, n FROM {sn} i JOIN (SELECT * FROM {few} WHERE n > 9) f ON i.caller = f.who", False),
    ]
    for form, sent in forms:
        server.asked()
        got, want = engine.sql(form.format(sn="sn.incident", few=few)), spark.sql(form.format(sn="plain_incidents", few=few))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), form
        assert any("callerINuser" in q.get("sysparm_query", "") for _, _, q, _, _ in server.asked()) == sent, form


def test_filters_pushed_or_not_give_equal_rows(engine, spark):
    import random

    r = random.Random(4)
    atoms = ["priority = 2", "priority > 1", "priority <= 2", "active = true", "caller = 'user3'", "caller IN ('user1', 'user2', 'none')", "number LIKE 'INC1%'", "caller IS NOT NULL", "caller IS NULL", "priority <> 3", "number > caller"]
    plain = spark.createDataFrame(INCIDENTS)
    plain.createOrReplaceTempView("plain_incidents")

    def tree(depth):
        if depth == 0:
            return r.choice(atoms)
        op = r.choice(["AND", "OR", "NOT"])
        return f"NOT ({tree(depth - 1)})" if op == "NOT" else f"({tree(depth - 1)}) {op} ({tree(depth - 1)})"

    for _ in range(12):
        where = tree(r.randint(1, 3))
        assert rows(engine.sql(f"SELECT number FROM sn.incident WHERE {where}")) == rows(spark.sql(f"SELECT number FROM plain_incidents WHERE {where}")), where


def test_changing_rows(engine, server):
    server.asked()
    out = engine.sql("UPDATE sn.incident SET priority = 9, caller = 'x, y' WHERE number = 'INC5' OR number = 'INC6'").first()[0]
    sent = [(p, b) for m, p, _, b, _ in server.asked() if m == "PATCH"]
    assert out == 2 and {p for p, _ in sent} == {"/api/now/table/incident/s005", "/api/now/table/incident/s006"} and sent[0][1] == {"priority": 9, "caller": "x, y"}
    assert engine.sql("DELETE FROM web.users WHERE id = ?", [4]).first()[0] == 1
    assert [p for m, p, *_ in server.asked() if m == "DELETE"] == ["/users/4"]
    with pytest.raises(errors.QueryError):
        engine.sql("DELETE FROM web.users")
    c = Connection(engine).cursor()
    c.executemany("INSERT INTO web.users (id, name) VALUES (?, ?)", [(100, "a"), (101, "b")])
    assert c.rowcount == 2 and sorted(b["id"] for m, p, _, b, _ in server.asked() if m == "POST" and p == "/users") == [100, 101]


def test_files(engine, spark):
    assert rows(engine.sql("SELECT id, value FROM files.items WHERE value > 150")) == [(2, 200), (3, 300)]
    assert rows(engine.sql("SELECT x.y FROM files.list")) == [(2,), (3,)]
    assert rows(engine.sql("SELECT id, ok FROM files.book")) == [(1, True), (2, False)]
    assert engine.list_tables("files") == ["book", "items", "list"]
    assert file_format("a/b.parquet") == "parquet" and file_format("x") == "csv"
    assert engine.sql("SELECT * FROM '/root/testdata/sf0.001/nation.parquet'").count() == 25
    assert engine.sql("SELECT * EXCLUDE (n_name) FROM '/root/testdata/sf0.001/nation.parquet'").columns == ["n_nationkey", "n_regionkey"]


def test_database_push_and_changes(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    con = spark._jvm.java.sql.DriverManager.getConnection(url)
    s = con.createStatement()
    s.executeUpdate("CREATE TABLE USERS (ID INT PRIMARY KEY, NAME VARCHAR(20), AGE INT)")
    s.executeUpdate("INSERT INTO USERS VALUES (1, 'Ann', 30), (2, 'Bob', 25), (3, 'Cy', 35)")
    con.close()
    e = Engine(spark)
    e.attach("db", url, driver="org.apache.derby.jdbc.EmbeddedDriver")
    df = e.sql("SELECT NAME FROM db.APP.USERS WHERE AGE > 26")
    assert rows(df) == [("Ann",), ("Cy",)] and "PushedFilters: [AGE IS NOT NULL, AGE > 26]" in df._jdf.queryExecution().toString()
    assert "PushedAggregates" in e.sql("SELECT max(AGE) AS m FROM db.APP.USERS")._jdf.queryExecution().toString()
    assert e.sql("UPDATE db.APP.USERS SET AGE = 40 WHERE ID = ?", [2]).first()[0] == 1
    assert e.sql("DELETE FROM db.APP.USERS WHERE AGE < 36").first()[0] == 2
    assert rows(e.sql("SELECT ID, AGE FROM db.APP.USERS")) == [(2, 40)]


def test_views_by_command(engine, spark):
    spark.range(5).createOrReplaceTempView("five")
    engine.sql("CREATE MATERIALIZED VIEW kept AS SELECT id FROM five WHERE id > 1")
    assert rows(engine.sql("SELECT * FROM kept")) == [(2,), (3,), (4,)]
    spark.range(7).createOrReplaceTempView("five")
    assert engine.sql("REFRESH MATERIALIZED VIEW kept").first()["rows"] == 5
    assert engine.views.stats("kept")["rows"] == 5 and engine.views.list() == ["kept"]
    with pytest.raises(errors.QueryError):
        engine.views.create("kept", "SELECT 1 AS x")
    engine.sql("CREATE MATERIALIZED VIEW IF NOT EXISTS kept AS SELECT 1 AS x")
    with pytest.raises(errors.QueryError):
        engine.views.create("bad name", "SELECT 1 AS x")
    engine.sql("DROP MATERIALIZED VIEW kept")
    assert not engine.views.exists("kept")


def test_dbapi(engine):
    with Connection(engine) as con:
        assert con.ping()
        c = con.execute("SELECT id FROM range(10) ORDER BY id")
        assert c.description[0][:2] == ("id", "bigint")
        assert [len(c.fetchmany(3)) for _ in range(4)] == [3, 3, 3, 1] and c.fetchone() is None
        assert list(con.execute("SELECT ? + 1 AS x", [4])) == [(5,)]
        assert "1." in con.execute("EXPLAIN SELECT count(*) FROM range(3)").fetchone()[0]
        assert con.execute("SELECT 1 AS x").to_arrow().num_rows == 1
    with pytest.raises(errors.QueryError):
        con.cursor()

    async def go():
        async with AsyncConnection(Connection(engine)) as a, a.cursor() as c:
            await c.execute("SELECT 7 AS x")
            return await c.fetchall()

    assert asyncio.run(go()) == [(7,)]
    with pytest.raises(errors.EngineError):
        engine.sql("SELECT nothing FROM nowhere")


def test_changes_of_a_source(engine):
    got = engine.changes("sn", "incident", since="2024-01-20 00:00:00", limit=5).collect()
    assert len(got) == 5 and {r.operation for r in got} == {"update"} and got[0].changed_at > "2024-01-20"


def test_schema_lattice():
    s = schema.infer_schema([{"a": 1, "n": {"x": 1}, "l": [1]}, {"a": 2.5, "n": {"y": True}, "l": ["s"], "z": None, "e": {}, "v": []}, {"b": True}, {"b": 3}])
    assert s.simpleString() == "struct<a:double,b:string,e:string,l:array<string>,n:struct<x:bigint,y:boolean>,v:array<string>,z:string>"
    deep = {}
    at = deep
    for _ in range(14):
        at["d"] = {}
        at = at["d"]
    at["x"] = 1
    assert "string" in schema.infer_schema([deep]).simpleString()
    assert schema.coerce("1", T.LongType()) == 1 and schema.coerce("x", T.LongType()) is None and schema.coerce("Yes", T.BooleanType()) is True
    assert schema.coerce({"a": 1}, T.StringType()) == "{'a': 1}" and schema.coerce(3, T.ArrayType(T.LongType())) is None


def test_schema_evolution_and_cache():
    a = T.StructType().add("x", T.LongType()).add("y", T.StringType())
    b = T.StructType().add("x", T.DoubleType()).add("z", T.BooleanType())
    d = schema.diff(a, b)
    assert (d.added, d.removed, d.changed) == (["z"], ["y"], {"x": ("bigint", "double")})
    assert schema.evolve(a, b).simpleString() == "struct<x:double,y:string,z:boolean>"
    with pytest.raises(errors.EvolutionError):
        schema.evolve(a, b, "strict")
    now = [0.0]
    cache = schema.SchemaCache(ttl=10, clock=lambda: now[0])
    cache.put("s", "t", a)
    assert cache.get("s", "t") == a and schema.fingerprint(a) != schema.fingerprint(b)
    now[0] = 11
    assert cache.get("s", "t") is None and cache.invalidate() == 0


def test_auth(server):
    assert auth.Auth({"username": "u", "password": "p"}).headers() == {"Authorization": "Basic dTpw"}
    assert auth.Auth({"api_key": "k", "api_key_header": "K", "api_key_prefix": "Token"}).headers() == {"K": "Token k"}
    assert auth.Auth({"api_key": "k", "api_key_param": "key"}).parameters() == {"key": "k"}
    assert auth.Auth({"token": "j"}).headers() == {"Authorization": "Bearer j"}
    o = auth.Auth({"oauth_token_url": server.base + "/token", "oauth_client_id": "c", "oauth_client_secret": "s", "api_key": "less"})
    server.asked()
    assert o.headers() == {"Authorization": "Bearer tok"} and o.headers() and len(server.asked()) == 1
    o._until = 0
    o.headers()
    assert "grant_type=refresh_token" in server.asked()[0][3]
    with pytest.raises(errors.ConfigError):
        auth.Auth({"oauth_token_url": "x", "oauth_grant": "password"})
    path = auth.keep_secret({"token": "x"})
    assert os.stat(path).st_mode & 0o077 == 0 and auth.of_file(path).kind == "bearer"


def test_retry_and_errors(server):
    server.http.refuse = 2
    assert Client(server.base, retry=Retry(base=0.01)).get("users", limit=1)
    server.http.refuse = 9
    with pytest.raises(errors.RateLimited) as e:
        Client(server.base, retry=Retry(tries=2, base=0.01)).get("users")
    server.http.refuse = 0
    assert e.value.code == "E006" and e.value.to_dict()["context"]["status"] == 429
    with pytest.raises(errors.SourceError):
        Client(server.base).get("missing")
    assert Retry().wait(20) <= 75 and Retry().wait(0, "7") == 7.0
    assert filters.soql(Predicate("a", "=", "it's")) == "a = 'it\\'s'" and filters.servicenow(Predicate("a", "=", "x^y")) is None


def test_stream_of_changes(engine, server, tmp_path):
    """Ties on the time are neither lost nor repeated, and a restart goes on from the checkpoint."""
    from fedspark.streaming import drain

    seen = []
    sink = lambda batch, n: seen.extend(batch.collect())
    drain(engine.stream_changes("sn", "incident"), sink, f"file://{tmp_path}/c")
    assert sorted(r.key for r in seen) == sorted(r["sys_id"] for r in INCIDENTS)
    assert {r.operation for r in seen} == {"insert", "update"}
    late = {**INCIDENTS[0], "sys_id": "s999", "sys_updated_on": max(r["sys_updated_on"] for r in INCIDENTS)}
    INCIDENTS.append(late)
    try:
        seen.clear()
        drain(engine.stream_changes("sn", "incident"), sink, f"file://{tmp_path}/c")
        assert [r.key for r in seen] == ["s999"] and '"sys_id": "s999"' in seen[0].data
    finally:
        INCIDENTS.remove(late)


def test_excel_in_a_shared_store(spark, tmp_path):
    from fedspark.sources.excel import read_excel

    (tmp_path / "a.xlsx").write_bytes(workbook(["id", "x"], [(1, 1.5), (2, None)]))
    assert rows(read_excel(spark, f"file://{tmp_path}/a.xlsx").na.fill(0.0)) == [(1, 1.5), (2, 0.0)]


def test_insert_by_query_and_subqueries(engine, server):
    server.asked()
    assert engine.sql("INSERT INTO web.users (id, name) SELECT id, name FROM files.items WHERE id < 3").first()[0] == 2
    assert len([1 for m, p, *_ in server.asked() if m == "POST"]) == 2
    assert rows(engine.sql("WITH a AS (SELECT id FROM web.users WHERE role = 'admin') SELECT i.id FROM files.items i WHERE i.id IN (SELECT id FROM a)")) == [(3,)]
    assert rows(engine.sql("SELECT (SELECT max(id) FROM web.users) AS m")) == [(25,)]


def test_jira_reads_all_rows_of_large_and_short_pages():
    """Neither a page size over the site's cap nor answers shorter than asked lose issues."""
    from fedspark.sources.api import Jira

    class Site(Jira):
        most = 100

        def send(self, r):
            at, n = r["body"]["startAt"], min(r["body"]["maxResults"], self.most)
            return {"total": 730, "issues": [{"id": i, "key": f"K-{i}", "fields": {}} for i in range(at, min(730, at + n))]}

    for size, most in (("500", 100), ("100", 30), ("70", 30)):
        site = Site({"base": "http://none", "table": "issues", "page_size": size})
        site.most = most
        assert [r["id"] for p in site.pages([], []) for r in site.read(p)] == list(range(730))
    few = Site({"base": "http://none", "table": "issues", "page_size": "500", "limit": "250"})
    assert [r["id"] for p in few.pages([], []) for r in few.read(p)] == list(range(250))


def test_scan_xlsx_keeps_every_row(spark, tmp_path):
    from fedspark.plans import federated

    spark.range(6001).selectExpr("cast(id as int) AS s_suppkey", "concat('S<', id) AS s_name", "id / 4 AS s_acctbal").write.parquet(str(tmp_path / "supplier.parquet"))
    want = [(i, f"S<{i}", i / 4) for i in range(6001)]
    assert rows(federated.scan_xlsx(spark, str(tmp_path))) == want
    (tmp_path / "none").mkdir()
    spark.range(0).selectExpr("cast(id as int) AS s_suppkey").write.parquet(str(tmp_path / "none" / "supplier.parquet"))
    assert federated.scan_xlsx(spark, str(tmp_path / "none")).count() == 0
