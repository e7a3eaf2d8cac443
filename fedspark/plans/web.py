"""Queries over web services (a stand-in in this process), the DB-API and the engine's own SQL."""

from __future__ import annotations

import asyncio
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workdir
from ..engine import Engine, connect
from ..sources.filters import Predicate
from ..streaming import ChangeConfig, drain
from .webstand import Stand, name, stand


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` in the columns and types that the table has in its file."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields if f.name in df.columns])


def _t(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _engine_and_stand(spark, sf, **keys) -> tuple[Engine, Stand]:
    """The stand's rows are loaded while the engine is set up; neither needs the other."""
    bound = inheritable_thread_target(spark)  # the session itself where threads are not pinned
    with ThreadPoolExecutor(1) as pool:
        coming = pool.submit(stand if bound is spark else bound(stand), spark, sf, **keys)
        return Engine(spark), coming.result()


def _rest(spark, sf, table="customer", key="c_custkey", path=None, **options) -> tuple[Engine, str, Stand]:
    (engine, s), db = _engine_and_stand(spark, sf, **{table: key}), name("rest")
    engine.attach(db, s.uri("http"), **{"data_path": "data.items", "paging": "offset", "page_size": 30, "strands": 12, "id_column": key, **options})
    engine.add_table(db, path or f"rows/{table}", table)
    return engine, db, s


def _tickets(spark, sf, *tables: tuple[str, str], **options) -> tuple[Engine, str, Stand]:
    engine, s, db = Engine(spark), stand(spark, sf, **dict(tables)), name("tickets")
    for table, key in tables:
        s.derive(table, "sys_id", key, str)
    s.keys = dict.fromkeys(s.keys, "sys_id")
    engine.attach(db, s.uri("servicenow"), [t for t, _ in tables], insecure=True, page_size=s.most, **options)
    return engine, db, s


def _objects(spark, sf, table="customer", key="c_custkey") -> tuple[Engine, str, Stand]:
    engine, s, db = Engine(spark), stand(spark, sf, **{table: key}), name("objects")
    s.derive(table, "Id", key, lambda v: f"A{v}")
    s.keys = {table: "Id"}
    engine.attach(db, s.uri("salesforce"), [table], insecure=True)
    return engine, db, s


def _issues(spark, sf) -> tuple[Engine, str, Stand]:
    engine, s, db = Engine(spark), stand(spark, sf, supplier="s_suppkey", region="r_regionkey"), name("issues")
    s.tables["issues"] = [{"key": f"S-{r['s_suppkey']}", "status": {"name": "Open" if r["s_nationkey"] < 10 else "Done"}, **r} for r in s.tables.pop("supplier")]
    s.tables["project"] = [{"id": str(r["r_regionkey"]), "key": r["r_name"][:2], "name": r["r_name"]} for r in s.tables.pop("region")]
    s.keys = {"issues": "key", "project": "id"}
    engine.attach(db, s.uri("jira"), ["issues", "project"], insecure=True)
    return engine, db, s


# scans


def web_rest_scan(spark, sf):
    """All pages by offset."""
    engine, db, _ = _rest(spark, sf)
    return _typed(engine.sql(f"SELECT * FROM {db}.customer"), _t(spark, sf, "customer"))


def web_rest_cursor(spark, sf):
    """Pages in a chain of cursors."""
    # Without a mode the endpoint would give all its rows at once, to find their schema.
    engine, db, _ = _rest(spark, sf, path="rows/customer?mode=cursor", paging="cursor", cursor_path="next", limit_param="size")
    return _typed(engine.sql(f"SELECT c_custkey, c_name FROM {db}.customer"), _t(spark, sf, "customer"))


def web_rest_filters(spark, sf):
    """Equality is sent as a parameter, the rest is tested here."""
    engine, db, _ = _rest(spark, sf)
    df = engine.sql(f"SELECT c_custkey, c_acctbal FROM {db}.customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000 AND c_name LIKE '%1%'")
    return _typed(df, _t(spark, sf, "customer"))


def web_tickets_scan(spark, sf):
    """Pages in parallel tasks; filters in the service's own form."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    df = engine.sql(f"SELECT c_custkey, c_name, c_nationkey FROM {db}.customer WHERE c_acctbal >= 500 AND c_nationkey IN (1, 3, 5, 7) AND c_name IS NOT NULL")
    return _typed(df, _t(spark, sf, "customer"))


def web_tickets_one_task(spark, sf):
    """The same pages in a chain, by one task."""
    engine, db, _ = _tickets(spark, sf, ("supplier", "s_suppkey"), parallel="false")
    return _typed(engine.sql(f"SELECT s_suppkey, s_name FROM {db}.supplier WHERE s_acctbal < 6000"), _t(spark, sf, "supplier"))


def web_tickets_order_limit(spark, sf):
    """Order and limit as options of a read."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    df = engine.table(db, "customer", order_by="c_acctbal desc,c_custkey", limit=70)
    return _typed(df.select("c_custkey", "c_acctbal"), _t(spark, sf, "customer"))


def web_tickets_attachments(spark, sf):
    """Content of attachments by id."""
    engine, db, _ = _tickets(spark, sf, ("region", "r_regionkey"))
    engine.add_table(db, "sys_attachment_content", "files")
    return engine.sql(f"SELECT sys_id, CAST(content AS STRING) AS content FROM {db}.files WHERE sys_id IN ('1', '2', '3')")


def web_tickets_tables(spark, sf):
    """Every page of the list of tables."""
    engine, db, s = _tickets(spark, sf, ("region", "r_regionkey"))
    s.tables |= {f"t{i:03}": [] for i in range(100)}
    return spark.createDataFrame([(t,) for t in engine.list_tables(db)], "name string")


def web_objects_scan(spark, sf):
    """A query in the service's language, read along its chain of pages."""
    engine, db, _ = _objects(spark, sf)
    df = engine.sql(f"SELECT c_custkey, c_name, c_acctbal FROM {db}.customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 4000 AND c_name LIKE 'Customer%'")
    return _typed(df, _t(spark, sf, "customer"))


def web_objects_describe(spark, sf):
    """Schema from the service's description."""
    engine, db, _ = _objects(spark, sf)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in engine.describe(db, "customer").fields], "name string, type string")


def web_issues_scan(spark, sf):
    """Issues by pages, nested fields as structs."""
    engine, db, _ = _issues(spark, sf)
    df = engine.sql(f"SELECT key, status.name AS status, s_suppkey, s_acctbal FROM {db}.issues WHERE s_nationkey > 4")
    return df.select("key", "status", F.col("s_suppkey").cast("bigint"), "s_acctbal")


def web_issues_lists(spark, sf):
    """A flat list of the site."""
    engine, db, _ = _issues(spark, sf)
    return engine.sql(f"SELECT id, key, name FROM {db}.project")


def web_join_files(spark, sf):
    """A web table with two of files."""
    engine, db, _ = _tickets(spark, sf, ("supplier", "s_suppkey"))
    files = name("files")
    engine.attach(files, sf, ["nation", "region"])
    return engine.sql(f"SELECT r_name, count(*) AS n, max(s_name) AS last FROM {db}.supplier JOIN {files}.nation ON s_nationkey = n_nationkey JOIN {files}.region ON n_regionkey = r_regionkey GROUP BY r_name")


def web_join_reduced(spark, sf):
    """Keys of the small side go to the service."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    few = _t(spark, sf, "nation").where("n_regionkey = 2")
    return engine.join_reduced(few, "n_nationkey", db, "customer", "c_nationkey").select(F.col("c_custkey").cast("bigint"), "n_name")


def web_join_reduced_sql(spark, sf):
    """The same from the engine's SQL alone."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    files = name("files")
    engine.attach(files, sf, ["nation"])
    df = engine.sql(f"SELECT c_custkey, n_name FROM {db}.customer JOIN {files}.nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
    return df.select(F.col("c_custkey").cast("bigint"), "n_name")


# aggregates


def web_tickets_aggregate(spark, sf):
    """Groups from the service's statistics; least and greatest keep their types."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    df = engine.aggregate(db, "customer", ["c_mktsegment"], [("count", None, "n"), ("min", "c_name", "first"), ("max", "c_custkey", "last")], [Predicate("c_nationkey", ">", 5)])
    assert engine.last_report.steps[0]["details"]["pushed"]
    return df


def web_tickets_aggregate_sql(spark, sf):
    """The same from SQL."""
    engine, db, _ = _tickets(spark, sf, ("customer", "c_custkey"))
    df = engine.sql(f"SELECT c_mktsegment, count(*) AS n, min(c_name) AS first, max(c_custkey) AS last FROM {db}.customer WHERE c_nationkey > 5 AND c_acctbal < 9000 GROUP BY c_mktsegment")
    assert any(s["step"] == "aggregate" for s in engine.last_report.steps)
    return df


def web_objects_aggregate_sql(spark, sf):
    """Groups in more than one page."""
    engine, db, _ = _objects(spark, sf, "customer", "c_custkey")
    df = engine.sql(f"SELECT c_name, count(*) AS n, max(c_custkey) AS last FROM {db}.customer WHERE c_acctbal > 0 GROUP BY c_name")
    assert any(s["step"] == "aggregate" for s in engine.last_report.steps)
    return df


def web_aggregate_here(spark, sf):
    """A service without aggregates: rows are grouped here."""
    engine, db, _ = _rest(spark, sf)
    return engine.sql(f"SELECT c_nationkey, count(*) AS n, max(c_name) AS last FROM {db}.customer GROUP BY c_nationkey").select(F.col("c_nationkey").cast("int"), "n", "last")


# changed rows


def web_rest_changes(spark, sf):
    """INSERT VALUES, UPDATE and DELETE of an endpoint."""
    engine, db, _ = _rest(spark, sf, "region", "r_regionkey")
    engine.sql(f"INSERT INTO {db}.region (r_regionkey, r_name) VALUES (90, 'ATLANTIS'), (91, 'MU')")
    engine.sql(f"UPDATE {db}.region SET r_name = 'LEMURIA' WHERE r_regionkey >= ?", [91])
    engine.sql(f"DELETE FROM {db}.region WHERE r_regionkey IN (0, 2)")
    return _typed(engine.sql(f"SELECT * FROM {db}.region"), _t(spark, sf, "region"))


def web_tickets_changes(spark, sf):
    engine, db, _ = _tickets(spark, sf, ("nation", "n_nationkey"))
    engine.sql(f"INSERT INTO {db}.nation (n_nationkey, n_name, n_regionkey, sys_id) SELECT 100 + r_regionkey, r_name, r_regionkey, concat('x', r_regionkey) FROM parquet.`{sf}/region.parquet`")
    engine.sql(f"UPDATE {db}.nation SET n_name = 'HERE' WHERE n_regionkey = 1 AND n_nationkey < 100")
    engine.sql(f"DELETE FROM {db}.nation WHERE n_name LIKE 'A%'")
    return _typed(engine.sql(f"SELECT n_nationkey, n_name, n_regionkey FROM {db}.nation"), _t(spark, sf, "nation"))


def web_objects_changes(spark, sf):
    """Rows one by one, and a bulk job."""
    engine, db, _ = _objects(spark, sf, "supplier", "s_suppkey")
    engine.sql(f"UPDATE {db}.supplier SET s_acctbal = -1.5 WHERE s_nationkey = 3")
    engine.sql(f"DELETE FROM {db}.supplier WHERE s_suppkey < 4")
    more = _t(spark, sf, "supplier").where("s_suppkey <= 2").select((F.col("s_suppkey") + 900000).alias("s_suppkey"), "s_name", "s_nationkey", F.concat(F.lit("B"), "s_suppkey").alias("Id"))
    engine.bulk_insert(db, "supplier", more)
    return _typed(engine.sql(f"SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {db}.supplier"), _t(spark, sf, "supplier"))


def web_issues_changes(spark, sf):
    engine, db, _ = _issues(spark, sf)
    engine.sql(f"UPDATE {db}.issues SET s_name = 'late' WHERE s_acctbal < 0")
    engine.sql(f"DELETE FROM {db}.issues WHERE s_suppkey > 7")
    return engine.sql(f"SELECT key, s_name FROM {db}.issues")


def web_change_stream(spark, sf):
    """A stream of a service's changes, drained twice: the second time only what is new comes."""
    engine, db, s = _tickets(spark, sf, ("supplier", "s_suppkey"))
    for i, r in enumerate(s.tables["supplier"]):
        r["sys_created_on"] = f"2024-01-{i % 28 + 1:02} 00:00:00"
        r["sys_updated_on"] = r["sys_created_on"] if i % 3 else "2024-02-01 00:00:00"
    engine.schemas.invalidate(db)
    engine.add_table(db, "supplier")
    out, mark = workdir.fresh(spark, "changes"), workdir.fresh(spark, "checkpoint")
    config = ChangeConfig("sys_updated_on", "sys_id", "sys_created_on")
    keep = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)
    drain(engine.stream_changes(db, "supplier", config), keep, mark)
    s.tables["supplier"].append({**s.tables["supplier"][0], "sys_id": "new", "sys_updated_on": "2024-03-01 00:00:00"})
    drain(engine.stream_changes(db, "supplier", config), keep, mark)
    return spark.read.parquet(out).groupBy("operation").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


# DB-API and the engine's SQL


def dbapi_cursor(spark, sf):
    """connect, bind parameters, fetch in parts."""
    with connect(f"{sf}/nation.parquet", spark, name=(db := name("one"))) as con, con.cursor() as c:
        c.execute(f"SELECT n_nationkey, n_name FROM {db}.nation WHERE n_regionkey = ? ORDER BY n_nationkey", [3])
        rows = [c.fetchone(), *c.fetchmany(2), *c.fetchall()]
        assert [d[0] for d in c.description] == ["n_nationkey", "n_name"]
    return spark.createDataFrame(rows, "n_nationkey int, n_name string")


def dbapi_executemany(spark, sf):
    """Many rows in one write."""
    engine, db, _ = _rest(spark, sf, "region", "r_regionkey")
    from ..dbapi import Connection

    c = Connection(engine).cursor()
    c.executemany(f"INSERT INTO {db}.region (r_regionkey, r_name) VALUES (?, ?)", [(50 + i, f"R{i}") for i in range(5)])
    return _typed(engine.sql(f"SELECT * FROM {db}.region"), _t(spark, sf, "region"))


def dbapi_async(spark, sf):
    """The asynchronous face, two statements at once."""
    from ..dbapi import AsyncConnection

    con = connect(f"{sf}/region.parquet", spark, name=(db := name("one")))

    async def one(r):
        async with AsyncConnection(con).cursor() as c:
            await c.execute(f"SELECT r_regionkey, r_name FROM {db}.region WHERE r_regionkey % 2 = ?", [r])
            return await c.fetchall()

    async def both():
        return await asyncio.gather(one(0), one(1))

    return spark.createDataFrame([r for part in asyncio.run(both()) for r in part], "r_regionkey int, r_name string")


def engine_qualify(spark, sf):
    """QUALIFY as the engine's SQL has it."""
    engine, db = Engine(spark), name("files")
    engine.attach(db, sf, ["orders"])
    return engine.sql(f"SELECT o_custkey, o_orderkey FROM {db}.orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")


def engine_path_in_from(spark, sf):
    """A quoted path in FROM."""
    return Engine(spark).sql(f"SELECT n_regionkey, count(*) AS n FROM '{sf}/nation.parquet' GROUP BY n_regionkey")


def engine_directory(spark, sf):
    """A folder's files as tables, types by suffix, csv with its types found."""
    folder = workdir.fresh(spark, "folder")
    _t(spark, sf, "customer").coalesce(1).write.csv(f"{folder}/customer.csv", header=True)
    engine, db = Engine(spark), name("files")
    engine.attach(db, f"{folder}/customer.csv/*.csv", ["customer"])
    engine.attach(db, sf, ["nation"])
    df = engine.sql(f"SELECT n_name, count(*) AS n, max(c_acctbal) AS most FROM {db}.customer JOIN {db}.nation ON c_nationkey = n_nationkey GROUP BY n_name")
    assert engine.describe(db, "customer")["c_acctbal"].dataType.simpleString() == "double"
    return df


def engine_local_tables(spark, sf):
    """CREATE TABLE AS, INSERT and DROP of a local table."""
    engine, db, where = Engine(spark), name("local"), workdir.fresh(spark, "local")
    spark.sql(f"CREATE DATABASE {db}")
    engine.sql(f"CREATE TABLE {db}.kept USING parquet LOCATION '{where}' AS SELECT n_nationkey, n_name FROM parquet.`{sf}/nation.parquet` WHERE n_regionkey = 1")
    engine.sql(f"INSERT INTO {db}.kept VALUES (77, 'NOWHERE')")
    df = engine.sql(f"SELECT * FROM {db}.kept")
    return df


def engine_materialized_view(spark, sf):
    """CREATE, REFRESH and DROP MATERIALIZED VIEW as statements."""
    engine = Engine(spark, workdir.fresh(spark, "views"))
    v = name("view")
    engine.sql(f"CREATE MATERIALIZED VIEW {v} AS SELECT c_mktsegment, count(*) AS n FROM parquet.`{sf}/customer.parquet` GROUP BY c_mktsegment")
    engine.sql(f"REFRESH MATERIALIZED VIEW {v} FULL")
    kept = engine.views.read(v)
    engine.sql(f"CREATE MATERIALIZED VIEW {v}b AS SELECT 1 AS x")
    engine.sql(f"DROP MATERIALIZED VIEW {v}b")
    assert f"{v}b" not in engine.views.list()
    return kept


_CUSTOMER = "SELECT * FROM customer"

ORACLES = {
    "web_rest_scan": _CUSTOMER,
    "web_rest_cursor": "SELECT c_custkey, c_name FROM customer",
    "web_rest_filters": "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000 AND c_name LIKE '%1%'",
    "web_tickets_scan": "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal >= 500 AND c_nationkey IN (1, 3, 5, 7)",
    "web_tickets_one_task": "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 6000",
    "web_tickets_order_limit": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 70",
    "web_tickets_attachments": "SELECT CAST(i AS VARCHAR) AS sys_id, 'file ' || i AS content FROM range(1, 4) r(i)",
    "web_tickets_tables": "SELECT 'region' AS name UNION ALL SELECT 't' || lpad(CAST(i AS VARCHAR), 3, '0') FROM range(100) r(i)",
    "web_objects_scan": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 4000 AND c_name LIKE 'Customer%'",
    "web_objects_describe": "SELECT * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'bigint'), ('c_acctbal', 'double'), ('c_mktsegment', 'string'), ('Id', 'string')) v(name, type)",
    "web_issues_scan": "SELECT 'S-' || s_suppkey AS key, CASE WHEN s_nationkey < 10 THEN 'Open' ELSE 'Done' END AS status, s_suppkey, s_acctbal FROM supplier WHERE s_nationkey > 4",
    "web_issues_lists": "SELECT CAST(r_regionkey AS VARCHAR) AS id, left(r_name, 2) AS key, r_name AS name FROM region",
    "web_join_files": "SELECT r_name, count(*) AS n, max(s_name) AS last FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "web_join_reduced": "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2",
    "web_join_reduced_sql": "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2",
    "web_tickets_aggregate": "SELECT c_mktsegment, count(*) AS n, min(c_name) AS first, max(c_custkey) AS last FROM customer WHERE c_nationkey > 5 GROUP BY c_mktsegment",
    "web_tickets_aggregate_sql": "SELECT c_mktsegment, count(*) AS n, min(c_name) AS first, max(c_custkey) AS last FROM customer WHERE c_nationkey > 5 AND c_acctbal < 9000 GROUP BY c_mktsegment",
    "web_objects_aggregate_sql": "SELECT c_name, count(*) AS n, max(c_custkey) AS last FROM customer WHERE c_acctbal > 0 GROUP BY c_name",
    "web_aggregate_here": "SELECT c_nationkey, count(*) AS n, max(c_name) AS last FROM customer GROUP BY c_nationkey",
    "web_rest_changes": "SELECT * FROM region WHERE r_regionkey NOT IN (0, 2) UNION ALL VALUES (90, 'ATLANTIS'), (91, 'LEMURIA')",
    "web_tickets_changes": "SELECT * FROM (SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN 'HERE' ELSE n_name END AS n_name, n_regionkey FROM nation UNION ALL SELECT 100 + r_regionkey, r_name, r_regionkey FROM region) WHERE n_name NOT LIKE 'A%'",
    "web_objects_changes": "SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_nationkey = 3 THEN -1.5 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_suppkey >= 4 UNION ALL SELECT s_suppkey + 900000, s_name, s_nationkey, NULL FROM supplier WHERE s_suppkey <= 2",
    "web_issues_changes": "SELECT 'S-' || s_suppkey AS key, CASE WHEN s_acctbal < 0 THEN 'late' ELSE s_name END AS s_name FROM supplier WHERE s_suppkey <= 7",
    "web_change_stream": "SELECT operation, count(*) AS n, count(DISTINCT key) AS keys FROM (SELECT CASE WHEN i % 3 = 0 THEN 'update' ELSE 'insert' END AS operation, i AS key FROM (SELECT row_number() OVER () - 1 AS i FROM supplier) UNION ALL SELECT 'update', -1) GROUP BY operation",
    "dbapi_cursor": "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3",
    "dbapi_executemany": "SELECT * FROM region UNION ALL SELECT CAST(50 + i AS INT), 'R' || i FROM range(5) r(i)",
    "dbapi_async": "SELECT * FROM region",
    "engine_qualify": "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
    "engine_path_in_from": "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey",
    "engine_directory": "SELECT n_name, count(*) AS n, max(c_acctbal) AS most FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "engine_local_tables": "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1 UNION ALL VALUES (77, 'NOWHERE')",
    "engine_materialized_view": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
}

QUERIES = [
    web_rest_scan, web_rest_cursor, web_rest_filters, web_tickets_scan, web_tickets_one_task, web_tickets_order_limit, web_tickets_attachments, web_tickets_tables,
    web_objects_scan, web_objects_describe, web_issues_scan, web_issues_lists, web_join_files, web_join_reduced, web_join_reduced_sql, web_tickets_aggregate, web_tickets_aggregate_sql,
    web_objects_aggregate_sql, web_aggregate_here, web_rest_changes, web_tickets_changes, web_objects_changes, web_issues_changes, web_change_stream,
    dbapi_cursor, dbapi_executemany, dbapi_async, engine_qualify, engine_path_in_from, engine_directory, engine_local_tables, engine_materialized_view,
]


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql():
    return dict(ORACLES)
