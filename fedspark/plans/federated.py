"""Queries over files of other kinds, custom operators, change feeds, views and functions."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workdir
from ..functions import split_lines, vowels, words_by
from ..operators import asof_join, positional_join, range_join, salted_join, semi_join_reduce, union_by_name
from ..streaming import ChangeConfig, changes_since, drain
from ..views import ViewStore


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scan_csv(spark, sf):
    path, part = workdir.fresh(spark, "csv"), _t(spark, sf, "part")
    part.write.csv(path, header=True)
    return spark.read.schema(part.schema).csv(path, header=True)


def scan_json(spark, sf):
    path, supplier = workdir.fresh(spark, "json"), _t(spark, sf, "supplier")
    supplier.write.json(path)
    return spark.read.schema(supplier.schema).json(path)


def scan_path_sql(spark, sf):
    return spark.sql(f"SELECT * FROM parquet.`{sf}/nation.parquet`")


def param_bind(spark, sf):
    return spark.sql(f"SELECT o_orderkey, o_totalprice FROM parquet.`{sf}/orders.parquet` WHERE o_orderstatus = ? AND o_totalprice > ?", args=["F", 200000.0])


def join_asof(spark, sf):
    events = _t(spark, sf, "events")
    buys = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("buy_id"))
    buys = buys.groupBy("user_id", "ts").agg(F.max("buy_id").alias("buy_id"))
    return asof_join(events.select("event_id", "user_id", "ts"), buys, "ts", ["user_id"], ["buy_id"], width=30 * 86400).select("event_id", "buy_id")


def join_asof_sliced(spark, sf):
    """The same with slices of a day, and ties by the event's number."""
    events = _t(spark, sf, "events")
    buys = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("buy_id"))
    return asof_join(events.select("event_id", "user_id", "ts"), buys, "ts", ["user_id"], ["buy_id"], tie="buy_id", width=86400).select("event_id", "buy_id")


def join_range(spark, sf):
    sizes = spark.createDataFrame([(0, 10, "s"), (10, 30, "m"), (30, 60, "l"), (5, 15, "x")], "lo int, hi int, band string")
    return range_join(_t(spark, sf, "part").select("p_partkey", "p_size"), sizes, "p_size", "lo", "hi", 10).select("p_partkey", "band")


def join_positional(spark, sf):
    return positional_join(_t(spark, sf, "nation").select("n_name"), _t(spark, sf, "region").select("r_name"), ["n_name"], ["r_name"])


def join_salted(spark, sf):
    return salted_join(_t(spark, sf, "lineitem"), _t(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"], 4).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def join_semijoin_reduced(spark, sf):
    few = _t(spark, sf, "customer").where("c_acctbal > 9500")
    reduced, _ = semi_join_reduce(few, _t(spark, sf, "orders"), "c_custkey", "o_custkey")
    return few.join(reduced, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


def join_cross_source(spark, sf):
    return scan_csv(spark, sf).join(_t(spark, sf, "lineitem"), F.col("p_partkey") == F.col("l_partkey")).groupBy("p_brand").agg(F.count("*").alias("n"))


def set_union_by_name(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return union_by_name(c, s)


_LOG = ChangeConfig(sync_column="o_orderdate", key_column="o_orderkey", batch_size=10_000, include_data=False)


def cdc_changes_since(spark, sf):
    return changes_since(_t(spark, sf, "orders"), _LOG, since="1998-01-01 00:00:00", limit=200)


def cdc_classify(spark, sf):
    log = _t(spark, sf, "orders").withColumn("made", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")).otherwise(F.lit("1990-01-01").cast("timestamp_ntz"))).withColumn("gone", F.col("o_orderkey") % 5 == 0)
    config = ChangeConfig("o_orderdate", "o_orderkey", "made", "gone", batch_size=None, include_data=False)
    return changes_since(log, config, since="2001-01-01 00:00:00").groupBy("operation").agg(F.count("*").alias("n"))


def cdc_batch_limit(spark, sf):
    """Two batches of 50 by (time, key): ties across the border are neither lost nor repeated."""
    orders = _t(spark, sf, "orders")
    one = changes_since(orders, _LOG, limit=50)
    last = one.orderBy(F.desc("changed_at"), F.desc(F.col("key").cast("long"))).first()
    two = changes_since(orders, _LOG, since=last["changed_at"], after_key=int(last["key"]), limit=50)
    return one.unionByName(two).select("key", "changed_at")


def cdc_stream_available_now(spark, sf):
    """All events through a stream with a durable checkpoint, counted by type."""
    events = _t(spark, sf, "events")
    source, out, mark = (workdir.fresh(spark, n) for n in ("events", "drained", "checkpoint"))
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    drain(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), mark)
    drain(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), mark)  # nothing is left to read
    return spark.read.schema(events.schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


def stream_tumbling(spark, sf):
    """Event-time windows of a stream with a watermark."""
    events = _t(spark, sf, "events")
    source, out, mark = (workdir.fresh(spark, n) for n in ("events", "windows", "checkpoint"))
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source).withColumn("at", F.col("ts").cast("timestamp"))
    windows = stream.withWatermark("at", "1 hour").groupBy(F.window("at", "1 day"), "event_type").agg(F.count("*").alias("n"))
    shown = windows.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")
    query = shown.writeStream.outputMode("complete").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(out)).option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(shown.schema).parquet(out)


def _views(spark) -> ViewStore:
    return ViewStore(spark, workdir.fresh(spark, "views"))


def _early(spark, sf, before="1998-01-01"):
    path = workdir.fresh(spark, "orders")
    orders = _t(spark, sf, "orders")
    orders.where(f"o_orderdate < timestamp_ntz'{before}'").write.parquet(path)
    return path, orders


def mv_create_query(spark, sf):
    store = _views(spark)
    store.create("by_status", f"SELECT o_orderstatus, count(*) AS n FROM parquet.`{sf}/orders.parquet` GROUP BY o_orderstatus")
    return store.read("by_status")


def mv_refresh_full(spark, sf):
    path, orders = _early(spark, sf)
    store = _views(spark)
    store.create("all_orders", f"SELECT o_orderkey, o_orderdate FROM parquet.`{path}`")
    orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    store.refresh("all_orders")
    return store.read("all_orders")


def mv_refresh_incremental(spark, sf):
    path, orders = _early(spark, sf)
    store = _views(spark)
    store.create("grown", f"SELECT o_orderkey, o_orderdate FROM parquet.`{path}` WHERE o_orderstatus <> 'P'", strategy="incremental", sync_column="o_orderdate")
    orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    store.refresh("grown")
    return store.read("grown")


def mv_upsert(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = workdir.fresh(spark, "orders")
    orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0)).withColumn("o_orderdate", F.lit("1990-01-01").cast("timestamp_ntz")).write.parquet(path)
    store = _views(spark)
    store.create("latest", f"SELECT * FROM parquet.`{path}`", strategy="incremental", sync_column="o_orderdate", key_column="o_orderkey")
    workdir.delete(spark, path)
    orders.write.parquet(path)
    spark.catalog.refreshByPath(path)
    store.refresh("latest")
    return store.read("latest")


def dml_insert_csv(spark, sf):
    path, region = workdir.fresh(spark, "insert"), _t(spark, sf, "region")
    region.write.csv(path, header=True)
    spark.createDataFrame([(90, "ATLANTIS"), (91, "MU")], region.schema).write.mode("append").csv(path, header=True)
    return spark.read.schema(region.schema).csv(path, header=True)


def udf_scalar(spark, sf):
    return _t(spark, sf, "benchmark").select("item_id", vowels()("text").alias("n"))


def udaf_pandas(spark, sf):
    return words_by(_t(spark, sf, "documents"), "lang")


def udtf_split(spark, sf):
    spark.udtf.register("split_lines", split_lines())
    return spark.sql(f"SELECT d.doc_id, l.line_no, l.line FROM (SELECT doc_id, text FROM parquet.`{sf}/documents.parquet`) d, LATERAL split_lines(d.text) l")


def scan_xlsx(spark, sf):
    """Workbooks of all suppliers by ranges of keys, read back through Spark's own file access."""
    from ..sources.excel import read_excel, write_excel

    supplier = _t(spark, sf, "supplier")
    path = workdir.fresh(spark, "books")
    write_excel(supplier.repartitionByRange("s_suppkey").sortWithinPartitions("s_suppkey"), path)
    return read_excel(spark, path, schema=supplier.schema)


def schema_infer_merge(spark, sf):
    """Types found in ragged records, as rows."""
    from ..schema import infer_schema

    records = [{"id": 1, "v": None, "u": {"name": "a", "score": 1}}, {"id": 2.5, "v": 4, "u": {"name": "b", "on": True}, "t": [1, 2.5]}, {"b": True}, {"b": 3, "e": {}, "l": []}]
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in infer_schema(records).fields], "name string, type string")


def schema_evolve(spark, sf):
    """The union of two tables' schemas, and what was added and removed."""
    from ..schema import diff, evolve

    old, new = _t(spark, sf, "customer").schema, _t(spark, sf, "supplier").schema
    d = diff(old, new)
    gone = {**dict.fromkeys(d.added, "added"), **dict.fromkeys(d.removed, "removed")}
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), gone.get(f.name, "same")) for f in evolve(old, new).fields], "name string, type string, change string")


def _derby(spark, sf):
    """An embedded database of the driver, attached to be changed."""
    from ..engine import Engine

    folder = tempfile.mkdtemp(prefix="fedspark-derby-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    url = f"jdbc:derby:{folder}/db"
    con = spark._jvm.java.sql.DriverManager.getConnection(f"{url};create=true")
    s = con.createStatement()
    s.executeUpdate("CREATE TABLE NATION (N_NATIONKEY INT PRIMARY KEY, N_NAME VARCHAR(40), N_REGIONKEY INT)")
    for r in _t(spark, sf, "nation").collect():
        s.executeUpdate(f"INSERT INTO NATION VALUES ({r['n_nationkey']}, '{r['n_name']}', {r['n_regionkey']})")
    con.close()
    engine = Engine(spark)
    name = f"derby{uuid.uuid4().hex}"
    engine.attach(name, url, driver="org.apache.derby.jdbc.EmbeddedDriver")
    return engine, name


def _published(engine, db) -> str:
    """The database as it is now, closed, packed and attached from the shared folder.

    An embedded database belongs to one process; packed, it is read-only and any executor can open it.
    """
    spark, url = engine.spark, engine.attached[db]["options"]["url"]
    try:
        spark._jvm.java.sql.DriverManager.getConnection(f"{url};shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # which says that it was closed
            raise
    folder = os.path.dirname(url.removeprefix("jdbc:derby:"))
    packed = shutil.make_archive(f"{folder}/packed", "zip", folder, "db")
    path = workdir.fresh(spark, "derby") + ".jar"
    fs, where = workdir.filesystem(spark, path)
    fs.copyFromLocalFile(spark._jvm.org.apache.hadoop.fs.Path(f"file://{packed}"), where)
    name = f"{db}_packed"
    engine.attach(name, f"jdbc:derby:jar:({re.sub('^file:/*', '/', path)})db", driver="org.apache.derby.jdbc.EmbeddedDriver")
    return name


def scan_jdbc(spark, sf):
    """Filter and aggregate run in the database."""
    engine, db = _derby(spark, sf)
    return engine.sql(f"SELECT N_REGIONKEY AS n_regionkey, count(*) AS n, max(N_NAME) AS last FROM {_published(engine, db)}.APP.NATION WHERE N_NATIONKEY > 3 GROUP BY N_REGIONKEY")


def dml_jdbc_update(spark, sf):
    engine, db = _derby(spark, sf)
    engine.sql(f"UPDATE {db}.APP.NATION SET N_NAME = 'X' WHERE N_REGIONKEY = ?", [1])
    return engine.sql(f"SELECT N_NATIONKEY AS n_nationkey, N_NAME AS n_name FROM {_published(engine, db)}.APP.NATION")


def dml_jdbc_delete(spark, sf):
    engine, db = _derby(spark, sf)
    engine.sql(f"DELETE FROM {db}.APP.NATION WHERE N_REGIONKEY < 2")
    return engine.sql(f"SELECT N_NATIONKEY AS n_nationkey FROM {_published(engine, db)}.APP.NATION")


def _attached(spark, sf):
    from ..engine import Engine

    engine = Engine(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS star")
    for t in ("nation", "region"):
        spark.sql(f"DROP TABLE IF EXISTS star.{t}")
        spark.sql(f"CREATE TABLE star.{t} USING parquet LOCATION '{sf}/{t}.parquet'")
    engine.attached["star"] = {"kind": "file"}
    return engine


def list_tables(spark, sf):
    return spark.createDataFrame([(t,) for t in _attached(spark, sf).list_tables("star")], "name string")


def describe_table(spark, sf):
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in _attached(spark, sf).describe("star", "nation").fields], "name string, type string")


def explain_report(spark, sf):
    return _attached(spark, sf).sql("EXPLAIN SELECT n_name FROM star.nation JOIN star.region ON n_regionkey = r_regionkey")


def quoted_names(spark, sf):
    return _attached(spark, sf).sql('SELECT "n_name" AS "name" FROM "star"."nation" WHERE "n_regionkey" = 2')


def agg_approx_distinct(spark, sf):
    return _t(spark, sf, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"))


_PART, _ORD = "SELECT * FROM part", "SELECT o_orderkey, o_orderdate FROM orders"

ORACLES = {
    "scan_csv": _PART,
    "scan_json": "SELECT * FROM supplier",
    "scan_path_sql": "SELECT * FROM nation",
    "param_bind": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000",
    "join_asof": "SELECT e.event_id, b.buy_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS buy_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) b ON e.user_id = b.user_id AND e.ts >= b.ts",
    "join_asof_sliced": "SELECT e.event_id, b.buy_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS buy_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) b ON e.user_id = b.user_id AND e.ts >= b.ts",
    "join_range": "SELECT p_partkey, band FROM part JOIN (VALUES (0, 10, 's'), (10, 30, 'm'), (30, 60, 'l'), (5, 15, 'x')) v(lo, hi, band) ON p_size >= lo AND p_size < hi",
    "join_positional": "SELECT n_name, r_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_name) AS k FROM nation) FULL JOIN (SELECT r_name, row_number() OVER (ORDER BY r_name) AS k FROM region) USING (k)",
    "join_salted": "SELECT o_orderstatus, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus",
    "join_semijoin_reduced": "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 9500",
    "join_cross_source": "SELECT p_brand, count(*) AS n FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_brand",
    "set_union_by_name": "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier",
    "cdc_changes_since": "SELECT 'unknown' AS operation, CAST(o_orderkey AS VARCHAR) AS key, o_orderdate AS changed_at FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 200",
    "cdc_classify": "SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'delete' WHEN o_orderkey % 3 = 0 THEN 'insert' ELSE 'update' END AS operation, count(*) AS n FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01' GROUP BY 1",
    "cdc_batch_limit": "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderdate AS changed_at FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100",
    "cdc_stream_available_now": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "stream_tumbling": "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "mv_create_query": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "mv_refresh_full": _ORD,
    "mv_refresh_incremental": _ORD + " WHERE o_orderstatus <> 'P'",
    "mv_upsert": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
    "dml_insert_csv": "SELECT * FROM region UNION ALL VALUES (90, 'ATLANTIS'), (91, 'MU')",
    "scan_xlsx": "SELECT * FROM supplier",
    "schema_infer_merge": "SELECT * FROM (VALUES ('b', 'string'), ('e', 'string'), ('id', 'double'), ('l', 'array<string>'), ('t', 'array<double>'), ('u', 'struct<name:string,on:boolean,score:bigint>'), ('v', 'bigint')) v(name, type)",
    "scan_jdbc": "SELECT n_regionkey, count(*) AS n, max(n_name) AS last FROM nation WHERE n_nationkey > 3 GROUP BY n_regionkey",
    "dml_jdbc_update": "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN 'X' ELSE n_name END AS n_name FROM nation",
    "dml_jdbc_delete": "SELECT n_nationkey FROM nation WHERE n_regionkey >= 2",
    "list_tables": "SELECT * FROM (VALUES ('nation'), ('region')) v(name)",
    "describe_table": "SELECT * FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) v(name, type)",
    "quoted_names": "SELECT n_name AS name FROM nation WHERE n_regionkey = 2",
    "udf_scalar": "SELECT item_id, CAST(length(regexp_replace(text, '[^aeiouAEIOU]', '', 'g')) AS BIGINT) AS n FROM benchmark",
    "udaf_pandas": r"SELECT lang, CAST(sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> ''))) AS BIGINT) AS n FROM documents GROUP BY lang",
    "udtf_split": "SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no, lines[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) u(i)",
}

QUERIES = [
    scan_csv, scan_json, scan_path_sql, param_bind, join_asof, join_asof_sliced, join_range, join_positional, join_salted, join_semijoin_reduced, join_cross_source, set_union_by_name,
    cdc_changes_since, cdc_classify, cdc_batch_limit, cdc_stream_available_now, stream_tumbling, mv_create_query, mv_refresh_full, mv_refresh_incremental, mv_upsert,
    dml_insert_csv, udf_scalar, udaf_pandas, udtf_split, agg_approx_distinct,
    scan_xlsx, schema_infer_merge, schema_evolve, scan_jdbc, dml_jdbc_update, dml_jdbc_delete, list_tables, describe_table, explain_report, quoted_names,
]


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql():
    return dict(ORACLES)
