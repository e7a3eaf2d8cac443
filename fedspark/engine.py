"""The engine: attach sources, run SQL over all of them, change rows, keep views, follow changes.

Every attached source is a database of the session; its tables are ordinary tables, so
joins, sub-queries and quoted names resolve in Spark's own analyser.  What Spark cannot
tell a Python source - which columns are read, a bare limit, and the keys of a small side
that it is joined with - is found in the optimized plan and given to it as options of that
one query.
"""

from __future__ import annotations

import glob
import json
import os
import re
import urllib.parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import qualify, ship, sources, workdir
from .errors import ConfigError, EngineError, QueryError, SourceError
from .functions import register as register_functions
from .operators import semi_join_reduce
from .report import Report
from .schema import SchemaCache
from .sources import auth, filters
from .streaming.changes import DEFAULTS, ChangeConfig, changes_since
from .views import ViewStore

_SECRETS = ("username", "password", "token", "api_key")
_SUFFIX = {".parquet": "parquet", ".json": "json", ".ndjson": "json", ".jsonl": "json", ".xlsx": "fedspark_excel", ".xls": "fedspark_excel", ".csv": "csv"}
#: Most bytes of files that are looked at for the keys of a join, most keys, and most characters of
#: them in a request; beyond these a join is not reduced, with the same rows.
REDUCED_BYTES, REDUCED_KEYS, REDUCED_CHARACTERS = 64 << 20, 2_000, 4_000
#: Functions that may say something else when the query is planned again.
_UNSTEADY = re.compile(r"\b(current_\w+|now|localtimestamp|curdate|unix_timestamp|rand\w*|uuid|shuffle|input_file_\w+)\b", re.I)
_PROBE = (".parquet", ".csv", ".json", ".xlsx", ".xls")


def file_format(path: str) -> str:
    """By suffix; csv where it tells nothing."""
    return _SUFFIX.get(os.path.splitext(path.rstrip("/"))[1].lower(), "csv")


class Engine:
    def __init__(self, spark: SparkSession, views: str | None = None):
        self.spark = spark
        ship.ship(spark)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        sources.register(spark)
        register_functions(spark)
        self.schemas = SchemaCache()
        self.attached: dict[str, dict] = {}
        self.tables_of: dict[tuple[str, str], dict] = {}
        self._views_root, self._views = views, None
        self.last_report: Report | None = None

    # sources

    def attach(self, name: str, uri: str, tables: list[str] | None = None, **options) -> None:
        """Attach a source as database ``name``.  Credentials go to a private file, not into table options."""
        if not re.fullmatch(r"\w+", name):
            raise ConfigError(f"{name!r} is no database name")
        u = urllib.parse.urlsplit(uri)
        kind = sources.SCHEMES.get(u.scheme.split("+")[0].lower() if u.scheme else "file")
        if kind is None:
            raise ConfigError(f"no source for {u.scheme}://", suggestion=f"one of {', '.join(sorted(sources.SCHEMES))}")
        options = {**dict(urllib.parse.parse_qsl(u.query)), **options}
        if u.username:
            options.setdefault("username", urllib.parse.unquote(u.username))
        if u.password:
            options.setdefault("password", urllib.parse.unquote(u.password))
        if kind == "jdbc":
            self._attach_jdbc(name, uri, options)
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
        if kind == "file":
            self.attached[name] = {"kind": "file"}
            path = uri if not u.scheme else u.path if u.scheme in ("file", "csv", "parquet", "json", "excel", "xlsx", "xls") else uri
            for table, where in self._files(path, tables):
                self._file_table(name, table, where)
            return
        secret = {k: options.pop(k) for k in list(options) if k in _SECRETS or k.startswith(("oauth_", "api_key_"))}
        scheme = "http" if options.pop("insecure", u.scheme == "http") else "https"
        base = options.pop("base", None) or (urllib.parse.urlunsplit((scheme, u.hostname + (f":{u.port}" if u.port else ""), u.path, "", "")))
        options = {k: str(v) for k, v in options.items()} | {"base": base}
        if secret:
            options["credential"] = auth.keep_secret(secret)
        self.attached[name] = {"kind": kind, "options": options}
        for table in tables or []:
            self.add_table(name, table)

    def _files(self, path: str, tables: list[str] | None):
        if os.path.isdir(path) and not path.endswith(".parquet"):
            if tables:
                for t in tables:
                    found = next((os.path.join(path, t + s) for s in _PROBE if os.path.exists(os.path.join(path, t + s))), None)
                    if found is None:
                        raise SourceError(f"no file for {t} in {path}")
                    yield t, found
            else:
                for f in sorted(os.listdir(path)):
                    if os.path.splitext(f)[1].lower() in _SUFFIX:
                        yield os.path.splitext(f)[0], os.path.join(path, f)
        else:
            for f in sorted(glob.glob(path)) or [path]:
                yield (tables or [os.path.splitext(os.path.basename(f.rstrip("/")))[0]])[0], f

    def _file_table(self, name: str, table: str, path: str) -> None:
        kind = file_format(path)
        extra = {"csv": "OPTIONS (header 'true', inferSchema 'true')", "json": "OPTIONS (multiLine 'true')" if path.endswith(".json") and os.path.isfile(path) else ""}.get(kind, "")
        self.spark.sql(f"DROP TABLE IF EXISTS `{name}`.`{table}`")
        if kind == "fedspark_excel":
            self.spark.sql(f"CREATE TABLE `{name}`.`{table}` USING {kind} OPTIONS (workbook '{path}')")
        else:
            self.spark.sql(f"CREATE TABLE `{name}`.`{table}` USING {kind} {extra} LOCATION '{path}'")
        self.tables_of[name, table] = {"format": kind, "path": path} | ({"options": {"workbook": path}, "kind": "excel"} if kind == "fedspark_excel" else {})

    def _attach_jdbc(self, name: str, uri: str, options: dict) -> None:
        """A Spark JDBC catalog: filters, aggregates, limits and top-N run in the database."""
        url = uri if uri.startswith("jdbc:") else "jdbc:" + re.sub(r"^(postgres)(?=:)", "postgresql", re.sub(r"^sql\+?", "", re.sub(r"//[^/@]*@", "//", uri)))
        base = f"spark.sql.catalog.{name}"
        self.spark.conf.set(base, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
        conf = {"url": url, "pushDownAggregate": "true", "pushDownLimit": "true", "pushDownOffset": "true", **{("user" if k == "username" else k): v for k, v in options.items()}}
        for k, v in conf.items():
            self.spark.conf.set(f"{base}.{k}", str(v))
        self.attached[name] = {"kind": "jdbc", "options": conf}

    def add_table(self, name: str, table: str, alias: str | None = None, **options) -> None:
        """A table of a web source, under its own name or ``alias``; its schema is found once and cached."""
        known = self.attached[name]
        all_options = {**known["options"], "table": table, **{k: str(v) for k, v in options.items()}}
        source = sources.KINDS[known["kind"]]
        alias = alias or re.sub(r"\W+", "_", table).strip("_")
        schema = self.schemas.get(name, alias)
        if schema is None:
            schema = source.api(all_options).discover()
            self.schemas.put(name, alias, schema)
        # Kept as an option, so that no query asks the source for it again.
        all_options["schema_json"] = schema.json()
        said = ", ".join(f"{k} {_quote(v)}" for k, v in all_options.items())
        self.spark.sql(f"DROP TABLE IF EXISTS `{name}`.`{alias}`")
        self.spark.sql(f"CREATE TABLE `{name}`.`{alias}` USING {source.name()} OPTIONS ({said})")
        self.tables_of[name, alias] = {"format": source.name(), "options": all_options, "kind": known["kind"]}

    def list_tables(self, name: str) -> list[str]:
        known = self.attached.get(name)
        if known is None:
            raise ConfigError(f"{name} is not attached")
        if known["kind"] in ("servicenow", "salesforce", "jira"):
            return sources.KINDS[known["kind"]].api({**known["options"], "table": ""}).tables()
        rows = self.spark.sql(f"SHOW TABLES IN `{name}`").collect()
        return sorted(r["tableName"] for r in rows if not r["isTemporary"])

    def describe(self, name: str, table: str):
        return self.spark.table(f"`{name}`.`{table}`").schema  # found when it was attached

    def table(self, name: str, table: str, **options) -> DataFrame:
        """A table with options of this read (columns, limit, order_by ...)."""
        key = self._web((name, table))
        if key is None:
            return self.spark.table(f"`{name}`.`{table}`")
        known = self.tables_of[key]
        return self.spark.read.format(known["format"]).options(**{**known["options"], **{k: str(v) for k, v in options.items()}}).load()

    # queries

    def sql(self, text: str, args=None) -> DataFrame:
        """A query or command.  Commands of views and changes to rows of sources are handled here."""
        report = self.last_report = Report(text)
        owned = self._owned(text, args)
        if owned is not None:
            report.step("command")
            return owned
        try:
            text = _dialect(text)
            df = self.spark.sql(_with_options(self, text, {}), args=args)
            report.step("analyse")
            told = self._aggregate_of(text, df) if args is None else None
            if told is not None:
                return told
            pushed = self._options_for(text, df)
            for table, keys in self._reductions(text, df).items():
                pushed.setdefault(table, {}).update(keys)
            if pushed:
                df = self.spark.sql(_with_options(self, text, pushed), args=args)
                for (n, t), o in pushed.items():
                    report.step("push", table=f"{n}.{t}", **o)
            return df
        except EngineError:
            raise
        except Exception as e:
            raise unwrap(e) from e

    def explain(self, text: str, args=None) -> str:
        """Steps and Spark's plan; the query is not run."""
        df = self.sql(text, args)
        self.last_report.plan = df._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return self.last_report.text()

    def _relations(self, text: str):
        """(name parts, first and last character) of every table named in ``text``."""
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        for node in _parsed(plan):
            if node.nodeName() == "UnresolvedRelation":
                names = tuple(_seq(node.multipartIdentifier()))
                yield names, node.origin().startIndex().get(), node.origin().stopIndex().get()

    def _web(self, names: tuple) -> tuple | None:
        """The key of a web table, if that is what ``names`` stand for."""
        low = tuple(n.lower() for n in names)
        return next((k for k, v in self.tables_of.items() if "options" in v and tuple(x.lower() for x in k) == low), None)

    def _options_for(self, text: str, df: DataFrame) -> dict:
        """Columns each web table is read for, and a limit that nothing stands above or below."""
        mine = {w for w in (self._web(n) for n, _, _ in self._relations(text)) if w}
        if not mine:
            return {}
        plan = df._jdf.queryExecution().optimizedPlan()
        used, chain, limit = set(), plan, None
        inner = _seq(plan.subqueriesAll())  # of expressions; they may read the same tables
        for one in [plan, *inner]:
            for node in _nodes(one):
                if node.children().size():
                    used |= _ids(node.references())
            used |= {a.exprId().id() for a in _seq(one.output())}
        while chain.children().size() == 1 and chain.nodeName() in ("GlobalLimit", "LocalLimit", "Project"):
            if chain.nodeName() == "GlobalLimit" and chain.limitExpr().nodeName() == "Literal":
                limit = chain.limitExpr().toString()
            chain = chain.children().apply(0)
        only_limit = limit is not None and not chain.children().size() and not inner
        out: dict = {}
        for leaf in [x for one in [plan, *inner] for x in _seq(one.collectLeaves())]:
            if "RelationV2" not in leaf.nodeName() and "DataSourceV2" not in leaf.getClass().getSimpleName():
                continue
            name = next((m for m in mine if _stands_for(leaf, m)), None)
            if name is None:
                continue
            names = [a.name() for a in _seq(leaf.output())]
            wanted = [a.name() for a in _seq(leaf.output()) if a.exprId().id() in used]
            have = out.setdefault(name, {"columns": []})
            have["columns"] += [c for c in wanted if c not in have["columns"]]
            have["all"] = names
            if only_limit:
                have["limit"] = limit
        final = {}
        for name, o in out.items():
            full = set(o.pop("all"))
            cols = o.pop("columns")
            if cols and set(cols) != full:
                o["columns"] = ",".join(cols)
            if o:
                final[name] = o
        return final

    def _reductions(self, text: str, df: DataFrame) -> dict:
        """Keys that web tables are joined with, for those that meet a small side of files or literals.

        Only rows that the join would drop are left out, and only of a table that the query
        reads once.  The small side's size is known from its files before it is read; it is
        the same later, as the list of files is fixed when the query is planned.
        """
        named = [w for w in (self._web(n) for n, _, _ in self._relations(text)) if w]
        if not named or _UNSTEADY.search(text):
            return {}
        plan = df._jdf.queryExecution().optimizedPlan()
        if plan.subqueriesAll().size():  # may read the same table
            return {}
        leaves = _seq(plan.collectLeaves())
        out: dict = {}
        for node in _nodes(plan):
            if node.nodeName() != "Join" or node.condition().isEmpty():
                continue
            for side, other in _reducible(node):
                leaf = _only_leaf(side)
                table = leaf and next((w for w in named if _stands_for(leaf, w)), None)
                if table is None or named.count(table) > 1 or sum(_stands_for(x, table) for x in leaves) > 1 or table in out:
                    continue
                told = self._small_keys(node.condition().get(), leaf, other)
                if told:
                    out[table] = {"semi_column": told[0], "semi_keys": json.dumps(told[1])}
        return out

    def _small_keys(self, condition, leaf, other) -> tuple[str, list] | None:
        """(column of the web table, the distinct keys of the other side), if these are few."""
        plain = all(_fixed(x) or x.nodeName() in ("Project", "Filter", "Join") for x in _nodes(other))
        if not plain or not other.deterministic() or int(str(other.stats().sizeInBytes())) > REDUCED_BYTES:
            return None
        mine, at = {a.exprId().id(): a for a in _seq(leaf.output())}, [a.exprId().id() for a in _seq(other.output())]
        for e in _conjuncts(condition):
            if not _is(e, "EqualTo"):
                continue
            sides = [_unwidened(x) for x in (e.left(), e.right())]
            if not all(_is(x, "AttributeReference") for x in sides):
                continue
            a, b = sides if sides[0].exprId().id() in mine else sides[::-1]
            if a.exprId().id() not in mine or b.exprId().id() not in at or a.dataType().simpleString() not in ("string", "tinyint", "smallint", "int", "bigint"):
                continue
            small = DataFrame(self.spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(self.spark._jsparkSession, other), self.spark)
            key = small.toDF(*[f"c{i}" for i in range(len(at))]).select(F.col(f"c{at.index(b.exprId().id())}").alias("k")).where("k is not null")
            keys = sorted(r[0] for r in key.distinct().limit(REDUCED_KEYS + 1).collect())
            sent = sum(len(urllib.parse.quote(str(k))) + 4 for k in keys)
            if keys and len(keys) <= REDUCED_KEYS and sent <= REDUCED_CHARACTERS and "" not in keys:
                return a.name(), keys
        return None

    def join_reduced(self, small: DataFrame, small_key: str, name: str, table: str, key: str, how: str = "inner") -> DataFrame:
        """Join a small side with a table of a source, sending the small side's keys there."""
        reduced, done = semi_join_reduce(small, self.table(name, table), small_key, key, how=how)
        self.last_report = Report(f"join {name}.{table}")
        self.last_report.step("semi-join reduction", applied=done.applied, keys=done.keys, reason=done.reason)
        return small.join(reduced, F.col(small_key) == reduced[key], how)

    def aggregate(self, name: str, table: str, group_by: list[str], measures: list[tuple[str, str | None, str]], where: list[filters.Predicate] = ()) -> DataFrame:
        """count, sum, avg, min, max by group: at the source where it can, else here; same rows."""
        known = self.tables_of.get(self._web((name, table)) or (name, table), {})
        kind = self.describe(name, table)
        api = sources.KINDS[known["kind"]].api(known["options"]) if known.get("kind") in sources.KINDS else None
        rows = None
        if api is not None and hasattr(api, "aggregate") and all(f in ("count", "sum", "avg", "min", "max") for f, _, _ in measures):
            rows = self._groups(known, api, list(where), group_by, measures)
        self.last_report = Report(f"aggregate {name}.{table}")
        self.last_report.step("aggregate", pushed=rows is not None)
        if rows is not None:
            told = [*((g, kind[g].dataType) for g in group_by), *((a, _measure_type(f, c, kind)) for f, c, a in measures)]
            return self._told(rows, list(range(len(told))), told)
        df = self.table(name, table)
        for p in where:
            df = df.where(_condition(p))
        out = [(F.count("*") if f == "count" and not c else getattr(F, f)(c)).cast(_measure_type(f, c, kind)).alias(a) for f, c, a in measures]
        return df.groupBy(*group_by).agg(*out)

    def _groups(self, known: dict, api, where: list, group_by: list[str], measures: list[tuple]) -> DataFrame | list[list] | None:
        """What a service tells of groups, as text: read by a task where it comes in pages, else here."""
        if not hasattr(api, "aggregate_request"):
            return api.aggregate(where, group_by, measures)
        asked = api.aggregate_request(where, group_by, measures)
        if asked is None:
            return None
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*group_by, *(f"m{i}" for i in range(len(measures))))])
        options = {**known["options"], "request": json.dumps(asked), "schema_json": schema.json()}
        return self.spark.read.format(known["format"]).options(**options).load().toDF(*[f"c{i}" for i in range(len(schema))])

    def _told(self, rows: DataFrame | list[list], at: list[int], columns: list[tuple]) -> DataFrame:
        """Places ``at`` of what a service told, which may be text, as columns of the types given."""
        text = rows
        if isinstance(rows, list):
            text = self.spark.createDataFrame([tuple(None if r[i] is None else str(r[i]) for i in range(max(at) + 1)) for r in rows], ", ".join(f"c{i} string" for i in range(max(at) + 1)))
        # Whole numbers may come as 7.0.
        whole = ("tinyint", "smallint", "int", "bigint")
        cast = lambda i, t: F.col(f"c{i}").cast("decimal(38,6)").cast(t) if t.simpleString() in whole else F.col(f"c{i}").cast(t)
        return text.select(*[cast(i, t).alias(name) for i, (name, t) in zip(at, columns, strict=True)])

    def _aggregate_of(self, text: str, df: DataFrame) -> DataFrame | None:
        """The answer to a query that is one aggregate over one web table, from the service itself.

        None where the service cannot say just that: other functions, expressions, filters
        that it does not have, or more than one table.
        """
        mine = [self._web(n) for n, _, _ in self._relations(text)]
        if len(mine) != 1 or mine[0] is None:
            return None
        known = self.tables_of[mine[0]]
        api = sources.KINDS[known["kind"]].api(known["options"]) if known.get("kind") in sources.KINDS else None
        if api is None or not hasattr(api, "aggregate"):
            return None
        plan = df._jdf.queryExecution().optimizedPlan()
        if plan.nodeName() != "Aggregate":
            return None
        kind = self.describe(*mine[0])
        group = [e.name() for e in _seq(plan.groupingExpressions()) if _is(e, "AttributeReference")]
        if len(group) != plan.groupingExpressions().size():
            return None
        columns, measures = [], []
        for e, field in zip(_seq(plan.aggregateExpressions()), df.schema.fields, strict=True):
            inner = e.child() if _is(e, "Alias") else e
            if _is(inner, "AttributeReference") and inner.name() in group:
                columns.append((inner.name(), field))
                continue
            measure = _measure(inner)
            if measure is None or measure[0] in ("sum", "avg"):  # a service may round these in its own way
                return None
            measures.append((*measure, field.name))
            columns.append((len(measures) - 1, field))
        where = _predicates(plan.child())
        if where is None or not measures:
            return None
        rows = self._groups(known, api, where, group, measures)
        if rows is None:
            return None
        self.last_report.step("aggregate", table=".".join(mine[0]), pushed=True)
        at = {g: i for i, g in enumerate(group)}
        places = [at[c] if isinstance(c, str) else len(group) + c for c, _ in columns]
        assert all(g in kind.fieldNames() for g in group)
        return self._told(rows, places, [(f.name, f.dataType) for _, f in columns])

    def bulk_insert(self, name: str, table: str, rows: DataFrame, most_bytes: int = 50 << 20) -> int:
        """Rows to a service's bulk jobs, from the tasks that have them; returns their number.

        A task that is run again sends its rows again; a service that can should be given
        an external id to know them by.
        """
        key = self._web((name, table))
        api = sources.KINDS[self.tables_of[key]["kind"]].api(self.tables_of[key]["options"])
        if not hasattr(api, "bulk_insert"):
            raise QueryError(f"{name} has no bulk jobs")
        columns = rows.columns

        def send(batches):
            import csv
            import io

            import pyarrow as pa

            n, out = 0, io.StringIO()
            for batch in batches:
                for r in batch.to_pylist():
                    csv.writer(out, lineterminator="\n").writerow(["" if r[c] is None else r[c] for c in columns])
                    n += 1
                    if out.tell() > most_bytes:
                        api.bulk_insert(columns, ",".join(columns) + "\n" + out.getvalue())
                        out = io.StringIO()
            if out.tell():
                api.bulk_insert(columns, ",".join(columns) + "\n" + out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

        return rows.mapInArrow(send, "n bigint").agg(F.sum("n")).first()[0] or 0

    # views, changes, rows

    @property
    def views(self) -> ViewStore:
        if self._views is None:
            self._views = ViewStore(self.spark, self._views_root, self.sql)
        return self._views

    def changes(self, name: str, table: str, config: ChangeConfig | None = None, **cursor) -> DataFrame:
        """One batch of changes of a table, in order of (time, key)."""
        known = self.tables_of.get((name, table), {})
        config = config or DEFAULTS.get(known.get("kind"), ChangeConfig())
        return changes_since(self.table(name, table), config, **cursor)

    def stream_changes(self, name: str, table: str, config: ChangeConfig | None = None) -> DataFrame:
        """An endless stream of changes (operation, key, changed_at, data); its checkpoint holds the place."""
        known = self.tables_of[self._web((name, table))]
        config = config or DEFAULTS.get(known["kind"], ChangeConfig())
        said = {"kind": known["kind"], "sync_column": config.sync_column, "key_column": config.key_column, "created_column": config.created_column, "deleted_column": config.deleted_column, "since": config.since}
        return self.spark.readStream.format("fedspark_changes").options(**{**known["options"], **{k: str(v) for k, v in said.items() if v is not None}}).load()

    def _owned(self, text: str, args) -> DataFrame | None:
        said = text.strip().rstrip(";")
        m = re.match(r"CREATE\s+MATERIALIZED\s+VIEW\s+(IF\s+NOT\s+EXISTS\s+)?(\w+)(\s+INCREMENTAL(?:\s+BY\s+(\w+))?(?:\s+KEY\s+(\w+))?)?\s+AS\s+(.*)", said, re.I | re.S)
        if m:
            self.views.create(m[2], m[6], "incremental" if m[3] else "full", m[4], m[5], bool(m[1]))
            return self.spark.createDataFrame([(m[2],)], "view string")
        m = re.match(r"REFRESH\s+MATERIALIZED\s+VIEW\s+(\w+)(\s+FULL)?\Z", said, re.I)
        if m:
            v = self.views.refresh(m[1], force_full=bool(m[2]))
            return self.spark.createDataFrame([(v.name, v.rows)], "view string, rows bigint")
        m = re.match(r"DROP\s+MATERIALIZED\s+VIEW\s+(IF\s+EXISTS\s+)?(\w+)\Z", said, re.I)
        if m:
            self.views.drop(m[2], bool(m[1]))
            return self.spark.createDataFrame([(m[2],)], "view string")
        m = re.match(r"EXPLAIN\s+(?!EXTENDED|CODEGEN|COST|FORMATTED)(.*)", said, re.I | re.S)
        if m:
            return self.spark.createDataFrame([(self.explain(m[1], args),)], "`Execution Plan` string")
        if re.match(r"(UPDATE|DELETE)\b", said, re.I):
            return self._change(said, args)
        m = re.match(r"INSERT\s+INTO\s+(?:TABLE\s+)?([`\"\w.]+)\s*(?:\(([^)]*)\)\s*)?((?:VALUES|SELECT|WITH|TABLE)\b.*)", said, re.I | re.S)
        if m:
            names = tuple(p.strip('`"') for p in m[1].split("."))
            if self._web(names):
                return self._insert(names, m[2], m[3], args)
        return None

    def _insert(self, names: tuple, columns: str | None, query: str, args) -> DataFrame:
        """All rows of a query or of VALUES, in one write."""
        given = self.sql(query, args)
        wanted = [c.strip(' `"') for c in columns.split(",")] if columns else self.describe(*names).fieldNames()
        if len(wanted) != len(given.columns):
            raise QueryError(f"{len(wanted)} columns are named, {len(given.columns)} given")
        n = self._write(self._web(names), given.toDF(*wanted))
        return self.spark.createDataFrame([(n,)], "num_affected_rows bigint")

    def _write(self, key: tuple, df: DataFrame) -> int:
        known = self.tables_of[key]
        schema = self.describe(*key)
        full = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        kept = full.persist()  # rows are counted and sent once each
        n = kept.count()
        kept.write.format(known["format"]).options(**known["options"]).mode("append").save()
        kept.unpersist()
        return n

    def _change(self, text: str, args) -> DataFrame | None:
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        kind = plan.nodeName()
        names = next(self._relations(text))[0]
        known = self.tables_of.get(self._web(names), {})
        where = re.search(r"\bWHERE\b(.*)\Z", text, re.I | re.S)
        if self.attached.get(names[0], {}).get("kind") == "jdbc":
            return self._jdbc_update(names, text, args)
        if known.get("kind") not in sources.KINDS:
            return None
        api = sources.KINDS[known["kind"]].api(known["options"])
        # The rows to change are found by a query, so any condition works; its tasks then send the keys.
        key = next((k for k in api.keys if k in self.describe(*names).fieldNames()), None)
        if key is None or not where:
            raise QueryError(f"{kind} needs a WHERE and the key column", suggestion=f"use {' or '.join(api.keys)}")
        marks = text[: where.start()].count("?")
        found = self.sql(f"SELECT `{key}` FROM `{names[0]}`.`{names[1]}` WHERE {where[1]}", list(args)[marks:] if args else None)
        changes = self._assignments(text, where.start(), args)
        gone = kind == "DeleteFromTable"

        def change(batches):
            """One request a key, in the task that found it; one run again finds a deleted row gone."""
            import pyarrow as pa

            n = 0
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    try:
                        api.delete(k) if gone else api.update(k, changes)
                    except EngineError as e:
                        if not gone or e.context.get("status") != 404:
                            raise
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

        # All keys are kept before the first row changes: pages read during the changes would skip rows.
        kept = workdir.fresh(self.spark, "keys")
        try:
            found.write.parquet(kept)
            n = self.spark.read.schema(found.schema).parquet(kept).mapInArrow(change, "n bigint").agg(F.sum("n")).first()[0] or 0
        finally:
            workdir.delete(self.spark, kept)
        return self.spark.createDataFrame([(n,)], "num_affected_rows bigint")

    def _assignments(self, text: str, end: int, args) -> dict:
        m = re.match(r"UPDATE\s+.*?\bSET\b(.*)", text[:end], re.I | re.S)
        if not m:
            return {}
        names = re.findall(r"(?:^|,)\s*`?(\w+)`?\s*=", re.sub(r"'(?:[^']|'')*'", lambda q: "'" + "x" * (len(q[0]) - 2) + "'", m[1]))
        values = re.sub(r"(^|,)(\s*)`?\w+`?\s*=(?=(?:[^']*'[^']*')*[^']*\Z)", r"\1\2", m[1])
        row = self.spark.sql(f"SELECT {values}", args=list(args)[: m[1].count('?')] if args else None).first()
        return dict(zip(names, row, strict=True))

    def _jdbc_update(self, names: tuple, text: str, args) -> DataFrame:
        conf = self.attached[names[0]]["options"]
        sql = re.sub(rf"\b{re.escape(names[0])}\.", "", text, count=1)
        con = self.spark._jvm.java.sql.DriverManager.getConnection(conf["url"], conf.get("user"), conf.get("password"))
        try:
            statement = con.prepareStatement(sql)
            for i, v in enumerate(args or [], 1):
                statement.setObject(i, v)
            n = statement.executeUpdate()
        finally:
            con.close()
        return self.spark.createDataFrame([(n,)], "num_affected_rows bigint")

    def insert_many(self, name: str, table: str, rows: list[tuple], columns: list[str] | None = None) -> int:
        """All rows in one write."""
        jdbc = self.attached[name]["kind"] == "jdbc"
        schema = self.spark.table(f"{name}.{table}" if jdbc else f"`{name}`.`{table}`").schema
        columns = columns or schema.fieldNames()
        given = self.spark.createDataFrame(rows, ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in columns))
        key = self._web((name, table))
        if key:
            return self._write(key, given)
        full = given.select(*[F.col(f"`{f.name}`") if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        if jdbc:
            full.writeTo(f"{name}.{table}").append()
        else:
            full.write.insertInto(f"{name}.{table}")
        return len(rows)


def _stands_for(leaf, table: tuple) -> bool:
    """Whether a plan's leaf reads this table."""
    return leaf.toString().strip().lower().endswith("." + ".".join(table).lower())


def _only_leaf(plan):
    """The one leaf below filters and plain projections; None if anything else stands there."""
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().apply(0)
    return None if plan.children().size() else plan


def _fixed(leaf) -> bool:
    """Whether a leaf has the same rows whenever it is read: files, whose list is fixed, and literals."""
    return _is(leaf, "LocalRelation") or _is(leaf, "LogicalRelation") and _is(leaf.relation(), "HadoopFsRelation")


def _reducible(join) -> list[tuple]:
    """(side, other side) of those sides of a join of which only rows with a partner count."""
    kind = join.joinType().toString()
    left = kind in ("Inner", "LeftSemi", "RightOuter")
    right = kind in ("Inner", "LeftSemi", "LeftAnti", "LeftOuter") or kind.startswith("ExistenceJoin")
    return [pair for pair, ok in (((join.left(), join.right()), left), ((join.right(), join.left()), right)) if ok]


def _quote(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _condition(p: filters.Predicate):
    c = F.col(f"`{p.column}`")
    return {
        "=": lambda: c == p.value, "!=": lambda: c != p.value, ">": lambda: c > p.value, ">=": lambda: c >= p.value, "<": lambda: c < p.value, "<=": lambda: c <= p.value,
        "in": lambda: c.isin(list(p.value)), "null": lambda: c.isNull(), "not null": lambda: c.isNotNull(), "starts": lambda: c.startswith(p.value), "ends": lambda: c.endswith(p.value), "contains": lambda: c.contains(p.value),
    }[p.op]()


def _measure_type(f: str, c: str | None, schema) -> T.DataType:
    """count is whole, sums and means are doubles, least and greatest keep the column's type."""
    return T.LongType() if f == "count" else schema[c].dataType if f in ("min", "max") else T.DoubleType()


def _is(node, name: str) -> bool:
    return node.getClass().getSimpleName() == name


def _measure(e) -> tuple[str, str | None] | None:
    """(function, column) of an aggregate expression that services have."""
    if not _is(e, "AggregateExpression") or e.isDistinct() or e.filter().isDefined():
        return None
    f = e.aggregateFunction()
    inner = _seq(f.children())
    name = {"Count": "count", "Sum": "sum", "Average": "avg", "Min": "min", "Max": "max"}.get(f.getClass().getSimpleName())
    if name is None or len(inner) != 1:
        return None
    if name == "count":
        return ("count", None) if _is(inner[0], "Literal") and inner[0].value() is not None else None
    return (name, inner[0].name()) if _is(inner[0], "AttributeReference") else None


def _predicates(plan) -> list[filters.Predicate] | None:
    """The filters below an aggregate, if they are all of forms that can be sent."""
    out: list[filters.Predicate] = []
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter"):
        if plan.nodeName() == "Project" and not all(_is(e, "AttributeReference") for e in _seq(plan.projectList())):
            return None
        if plan.nodeName() == "Filter":
            for c in _conjuncts(plan.condition()):
                p = _predicate(c)
                if p is None:
                    return None
                out.append(p)
        plan = plan.children().apply(0)
    return out if not plan.children().size() else None


def _unwidened(e):
    """An attribute below a cast to a wider whole number, which changes no value."""
    whole = ("tinyint", "smallint", "int", "bigint")
    wider = _is(e, "Cast") and e.child().dataType().simpleString() in whole and e.dataType().simpleString() in whole
    return e.child() if wider and whole.index(e.child().dataType().simpleString()) < whole.index(e.dataType().simpleString()) else e


def _conjuncts(e):
    if _is(e, "And"):
        yield from _conjuncts(e.left())
        yield from _conjuncts(e.right())
    else:
        yield e


def _predicate(e) -> filters.Predicate | None:
    name = e.getClass().getSimpleName()
    if name in ("IsNull", "IsNotNull"):
        return filters.Predicate(e.child().name(), "null" if name == "IsNull" else "not null") if _is(e.child(), "AttributeReference") else None
    if name == "Not" and _is(e.child(), "EqualTo"):
        inner = _predicate(e.child())
        return inner and filters.Predicate(inner.column, "!=", inner.value)
    op = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}.get(name)
    if op is None or not _is(e.left(), "AttributeReference") or not _is(e.right(), "Literal"):
        return None
    value, kind = e.right().value(), e.right().dataType().simpleString()
    if value is None or kind not in ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean"):
        return None
    return filters.Predicate(e.left().name(), op, value.toString() if kind == "string" and not isinstance(value, str) else value)


def _dialect(text: str) -> str:
    """Small differences: quoted identifiers, quoted file paths, EXCLUDE, QUALIFY."""
    out = re.sub(r"\b(FROM|JOIN)\s+'([^']+)'", lambda m: f"{m[1]} {'json' if file_format(m[2]) == 'json' else file_format(m[2])}.`{m[2]}`", text, flags=re.I)
    out = re.sub(r"\*\s*EXCLUDE\s*\(", "* EXCEPT (", out, flags=re.I)
    parts = re.split(r"('(?:[^'\\]|\\.|'')*')", out)  # outside of strings
    return qualify.rewrite("".join(p if i % 2 else re.sub(r'"([^"]+)"', r"`\1`", p) for i, p in enumerate(parts)))


def _with_options(engine: Engine, text: str, pushed: dict) -> str:
    """The query with the options of its web tables spelled out: those stored with a table do not
    reach a Python source's reader, and this read may have its own."""
    if not any("options" in v for v in engine.tables_of.values()):
        return text
    try:
        named = sorted(set(engine._relations(text)), key=lambda r: -r[2])
    except Exception:  # not a query; Spark says what is wrong
        return text
    for names, _, stop in named:
        key = engine._web(names)
        if key:
            options = {**engine.tables_of[key]["options"], **pushed.get(key, {})}
            text = f"{text[: stop + 1]} WITH ({', '.join(f'`{k}` = {_quote(v)}' for k, v in options.items())}){text[stop + 1 :]}"
    return text


def _parsed(plan):
    """All nodes of a parsed plan, those of CTEs and sub-queries included."""
    yield plan
    for inner in [*_seq(plan.children()), *_seq(plan.innerChildren().toSeq())]:
        if hasattr(inner, "innerChildren"):
            yield from _parsed(inner)
    stack = _seq(plan.expressions().toSeq())
    while stack:
        e = stack.pop()
        if e.getClass().getSimpleName() in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "UnresolvedSubqueryExpression"):
            yield from _parsed(e.plan())
        stack += _seq(e.children())


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def _nodes(plan):
    yield plan
    for c in _seq(plan.children()):
        yield from _nodes(c)


def _ids(attributes) -> set:
    return {a.exprId().id() for a in _seq(attributes.toSeq())}


def unwrap(e: Exception) -> Exception:
    """Our own error inside one that Spark made of it."""
    from . import errors

    m = re.search(r"fedspark\.errors\.(\w+): \[E\d+\] ([^\n]*)", str(e))
    if m and hasattr(errors, m[1]):
        return getattr(errors, m[1])(m[2])
    return QueryError(str(e).split("\n")[0])


def connect(uri: str, spark: SparkSession | None = None, name: str = "default_source", **options):
    """A DB-API connection with one source attached."""
    from .dbapi import Connection

    engine = Engine(spark or SparkSession.builder.getOrCreate())
    if uri:
        engine.attach(name, uri, **options)
    return Connection(engine)
