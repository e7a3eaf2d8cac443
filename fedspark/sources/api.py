"""Web APIs as Spark Python data sources.

A source answers four questions - what a table's address is, how filters, columns,
order and limit are said there, how many pages there are, and where the rows stand in
an answer - and the shared reader makes one task a run of pages.  Options:

``base``, ``table``, ``credential`` (file), ``page_size``, ``columns``, ``limit``,
``order_by``, ``filters`` (``off`` to send none), ``retries``, ``retry_base``, ``timeout``,
``request`` (JSON: read the answers to this request and those that follow, in place of the table).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from ..errors import QueryError
from ..schema.infer import coerce, infer_schema, row
from . import auth, filters
from .http import Client, Retry, dig


@dataclass
class Page(InputPartition):
    """A request, and how many rows of its answer count."""

    offset: int = 0
    size: int = 0
    request: dict | None = None


#: Most tasks of one read; a task reads neighbouring pages one after the other.
TASKS = 48
#: Rows that are handed on at once, and the types of values that a column takes as they are.
BATCH, AS_IT_IS = 4096, {T.StringType(): {str}, T.LongType(): {int}, T.DoubleType(): {float}, T.BooleanType(): {bool}}


@dataclass
class Run(InputPartition):
    """The pages of one task."""

    pages: list[Page]


class Api:
    """One kind of service.  ``o`` are the table's options."""

    page_size = 1000
    schema_rows = 100

    def __init__(self, options: dict, known: auth.Auth | None = None):
        self.o = {k.lower(): v for k, v in dict(options).items()}
        if "base" not in self.o:
            raise QueryError("the option base is missing")
        a = known or auth.of_file(self.o.get("credential"))
        retry = Retry(tries=int(self.o.get("retries", 5)), base=float(self.o.get("retry_base", 1.0)))
        self.client = Client(self.o["base"], None, a.parameters(), float(self.o.get("timeout", 30)), retry, a)
        self.size = int(self.o.get("page_size", self.page_size))
        self.table = self.o.get("table", "")
        self.columns = [c for c in self.o.get("columns", "").split(",") if c]
        self.limit = int(self.o["limit"]) if "limit" in self.o else None

    # what a service defines

    def request(self, predicates, columns, offset: int, size: int) -> dict:
        """A request for rows offset .. offset + size: method, path, query, body."""
        raise NotImplementedError

    def rows(self, answer) -> list[dict]:
        raise NotImplementedError

    def total(self, predicates) -> int | None:
        """Number of rows, if the service tells; None reads page after page in one task."""
        return None

    def following(self, answer, asked: dict, got: int) -> dict | None:
        """The next request where pages form a chain."""
        return None

    # shared

    def send(self, r: dict):
        return self.client.request(r.get("method", "GET"), r["path"], r.get("query"), r.get("body"))

    def discover(self) -> T.StructType:
        answer = self.send(self.request([], [], 0, min(self.size, self.schema_rows)))
        return infer_schema(self.rows(answer))

    def pages(self, predicates, columns) -> list[Page]:
        total = self.total(predicates)
        if total is None:
            return [Page(0, -1 if self.limit is None else self.limit, self.request(predicates, columns, 0, self.size if self.limit is None else min(self.size, self.limit)))]
        if self.limit is not None:
            total = min(total, self.limit)
        return [Page(at, min(self.size, total - at), self.request(predicates, columns, at, min(self.size, total - at))) for at in range(0, total, self.size)] or [Page(0, 0, None)]

    def read(self, page: Page) -> Iterator[dict]:
        if page.request is None:
            return
        asked, left = page.request, page.size
        while asked is not None:
            answer = self.send(asked)
            got = self.rows(answer)
            for r in got if left < 0 else got[:left]:
                yield r
            if left >= 0:
                left -= len(got)
                if left <= 0:
                    return
            asked = self.following(answer, asked, len(got))


class ApiReader(DataSourceReader):
    def __init__(self, api: Api, schema: T.StructType):
        self.api, self.schema, self.predicates = api, schema, []
        if "semi_column" in api.o and api.o.get("filters") != "off":  # keys that the table is joined with
            self.predicates.append(filters.Predicate(api.o["semi_column"], "in", tuple(json.loads(api.o["semi_keys"]))))

    def pushFilters(self, pushed):
        for f in pushed:
            p = filters.predicate(f)
            if p is not None and self.api.o.get("filters") != "off":
                self.predicates.append(p)
            yield f  # Spark checks it again

    def partitions(self):
        if "request" in self.api.o:
            return [Run([Page(0, -1, json.loads(self.api.o["request"]))])]
        wanted = self.api.columns or []
        # Filtered columns must come back, as Spark looks at them again.
        columns = [*wanted, *sorted({p.column for p in self.predicates} - set(wanted))] if wanted else []
        pages = self.api.pages(self.predicates, columns)
        step = -(-len(pages) // TASKS)
        return [Run(pages[at : at + step]) for at in range(0, len(pages), step)]

    def read(self, partition):
        rows = (r for page in partition.pages for r in self.api.read(page))
        if not all(f.dataType in AS_IT_IS for f in self.schema.fields):
            yield from (row(r, self.schema) for r in rows)
            return
        kinds = to_arrow_schema(self.schema)
        for some in batched(rows, BATCH):
            yield pa.RecordBatch.from_arrays([pa.array(self._values(some, f), k.type) for f, k in zip(self.schema.fields, kinds, strict=True)], schema=kinds)

    @staticmethod
    def _values(rows, field) -> list:
        values = [r.get(field.name) for r in rows]
        plain = {*map(type, values)} - {type(None)} <= AS_IT_IS[field.dataType]
        return values if plain else [coerce(v, field.dataType) for v in values]


class ApiWriter(DataSourceWriter):
    """Inserts row by row; the number of rows written is what tasks commit."""

    def __init__(self, api: Api, schema: T.StructType):
        self.api, self.schema = api, schema

    def write(self, iterator):
        for r in iterator:
            self.api.insert({k: v for k, v in r.asDict(recursive=True).items() if v is not None})
        return WriterCommitMessage()


class _Source(DataSource):
    api: type[Api] = Api

    def schema(self):
        known = next((v for k, v in dict(self.options).items() if k.lower() == "schema_json"), None)
        return T.StructType.fromJson(json.loads(known)) if known else self.api(self.options).discover()

    def reader(self, schema):
        return ApiReader(self.api(self.options), schema)

    def writer(self, schema, overwrite):
        return ApiWriter(self.api(self.options), schema)


class Rest(Api):
    """A JSON endpoint.  ``data_path``, ``paging`` (none, offset, page, cursor), ``limit_param``,
    ``offset_param``, ``page_param``, ``cursor_path``, ``cursor_param``, ``filter_param``
    (one JSON object instead of parameters), ``id_column``, ``strands``: that many tasks read pages
    in turn, each to its first page that is not full; only for services that keep to the size asked
    for and answer with no rows beyond the end."""

    page_size = 100

    @property
    def strands(self):
        return int(self.o.get("strands", 1)) if self.o.get("paging") in ("offset", "page") and self.limit is None else 1

    def pages(self, predicates, columns):
        if self.strands == 1:
            return super().pages(predicates, columns)
        return [Page(at, -1, self.request(predicates, columns, at, self.size)) for at in range(0, self.strands * self.size, self.size)]

    def request(self, predicates, columns, offset, size):
        query = {}
        sent = filters.parameters(predicates)
        if self.o.get("server_filter", "true") == "true" and sent:
            query = {self.o["filter_param"]: json.dumps(sent)} if "filter_param" in self.o else dict(sent)
        paging = self.o.get("paging", "none")
        if paging in ("offset", "page", "cursor"):
            query[self.o.get("limit_param", "limit")] = size
        if paging == "offset":
            query[self.o.get("offset_param", "offset")] = offset
        if paging == "page":
            query[self.o.get("page_param", "page")] = offset // self.size + 1
        return {"path": self.table, "query": query}

    def rows(self, answer):
        got = dig(answer, self.o.get("data_path"))
        got = [] if got is None else got if isinstance(got, list) else [got]
        return [r for r in got if isinstance(r, dict)]

    def following(self, answer, asked, got):
        paging, query = self.o.get("paging", "none"), dict(asked.get("query") or {})
        if not got or paging == "none":
            return None
        if paging == "cursor":
            cursor = dig(answer, self.o.get("cursor_path", "next"))
            if not cursor:
                return None
            return {"path": cursor} if str(cursor).startswith("http") else {**asked, "query": {**query, self.o.get("cursor_param", "cursor"): cursor}}
        if got < int(query[self.o.get("limit_param", "limit")]):
            return None
        key, step = (self.o.get("offset_param", "offset"), got if self.strands == 1 else self.strands * self.size) if paging == "offset" else (self.o.get("page_param", "page"), self.strands)
        return {**asked, "query": {**query, key: int(query[key]) + step}}

    def insert(self, record):
        return self.client.request("POST", self.table, body=record)

    def update(self, key, changes):
        return self.client.request("PATCH", f"{self.table}/{key}", body=changes)

    def delete(self, key):
        return self.client.request("DELETE", f"{self.table}/{key}")

    @property
    def keys(self):
        return (self.o.get("id_column", "id"),)


class RestSource(_Source):
    api = Rest

    @classmethod
    def name(cls):
        return "fedspark_rest"


class ServiceNow(Api):
    """Tables of a ServiceNow instance, attachments' content included."""

    keys = ("sys_id",)
    TYPES = {"integer": "bigint", "boolean": "boolean", "decimal": "double", "float": "double"}

    def request(self, predicates, columns, offset, size):
        parts = [t for t in map(filters.servicenow, predicates) if t]
        for c in [c for c in self.o.get("order_by", "").split(",") if c]:
            name, _, way = c.partition(" ")
            parts.append(("ORDERBYDESC" if way.strip().lower() == "desc" else "ORDERBY") + name)
        if not any(p.startswith("ORDERBY") for p in parts):
            parts.append("ORDERBYsys_id")  # pages need a fixed order
        query = {"sysparm_query": "^".join(parts), "sysparm_limit": size, "sysparm_offset": offset, "sysparm_display_value": self.o.get("display_value", "false")}
        if columns:
            query["sysparm_fields"] = ",".join(columns)
        return {"path": f"api/now/table/{self.table}", "query": query}

    def rows(self, answer):
        return answer.get("result") or []

    def following(self, answer, asked, got):
        q = asked["query"]
        return {**asked, "query": {**q, "sysparm_offset": int(q["sysparm_offset"]) + got}} if got >= int(q["sysparm_limit"]) else None

    def total(self, predicates):
        if self.o.get("parallel", "true") != "true":
            return None
        parts = [t for t in map(filters.servicenow, predicates) if t]
        answer = self.client.request("GET", f"api/now/stats/{self.table}", {"sysparm_count": "true", "sysparm_query": "^".join(parts) or None})
        return int(answer["result"]["stats"]["count"])

    def discover(self):
        if self.table == "sys_attachment_content":
            return T.StructType([T.StructField("sys_id", T.StringType()), T.StructField("content", T.BinaryType())])
        return super().discover()

    def pages(self, predicates, columns):
        if self.table == "sys_attachment_content":
            ids = [v for p in predicates if p.column == "sys_id" for v in (p.value if p.op == "in" else (p.value,) if p.op == "=" else ())]
            if not ids:
                raise QueryError("attachment content needs sys_id = or IN", suggestion="add WHERE sys_id = '...'")
            return [Page(0, -1, {"path": f"api/now/attachment/{i}/file", "id": i}) for i in ids]
        return super().pages(predicates, columns)

    def read(self, page):
        if page.request and "id" in page.request:
            yield {"sys_id": page.request["id"], "content": self.client.request("GET", page.request["path"], raw=True)}
        else:
            yield from super().read(page)

    def tables(self):
        names, at = [], 0
        while True:
            got = self.client.get("api/now/table/sys_db_object", sysparm_fields="name", sysparm_query="ORDERBYname", sysparm_limit=self.size, sysparm_offset=at)["result"]
            names += [r["name"] for r in got]
            at += len(got)
            if len(got) < self.size:
                return sorted(set(names))

    def aggregate(self, predicates, group_by, measures):
        """Rows of the Stats API; measures are (function, column, alias)."""
        parts = [filters.servicenow(p) for p in predicates]
        if None in parts:
            return None
        query = {"sysparm_query": "^".join(parts) or None, "sysparm_group_by": ",".join(group_by) or None}
        for f, c, _ in measures:
            if f == "count":
                query["sysparm_count"] = "true"
            else:
                key = f"sysparm_{f}_fields"
                query[key] = ",".join(filter(None, [query.get(key), c]))
        got = self.client.request("GET", f"api/now/stats/{self.table}", query)["result"]
        out = []
        for g in got if isinstance(got, list) else [got]:
            keys = {x["field"]: x["value"] for x in g.get("groupby_fields", [])}
            stats = g["stats"]
            values = [(stats["count"] if f == "count" else stats[f][c]) or None for f, c, _ in measures]
            out.append([*(keys.get(k) for k in group_by), *values])
        return out

    def insert(self, record):
        return self.client.request("POST", f"api/now/table/{self.table}", body=record)

    def update(self, key, changes):
        return self.client.request("PATCH", f"api/now/table/{self.table}/{key}", body=changes)

    def delete(self, key):
        return self.client.request("DELETE", f"api/now/table/{self.table}/{key}")


class ServiceNowSource(_Source):
    api = ServiceNow

    @classmethod
    def name(cls):
        return "fedspark_servicenow"


class Salesforce(Api):
    """SOQL objects; pages form a chain, so one task reads them."""

    keys = ("Id",)
    version = "v59.0"
    TYPES = {"boolean": T.BooleanType, "int": T.LongType, "double": T.DoubleType, "percent": T.DoubleType, "currency": T.DoubleType}

    def _path(self, tail):
        return f"services/data/{self.o.get('version', self.version)}/{tail}"

    def where(self, predicates):
        parts = [t for t in map(filters.soql, predicates) if t]
        return " WHERE " + " AND ".join(parts) if parts else ""

    def request(self, predicates, columns, offset, size):
        q = f"SELECT {', '.join(columns or [f.name for f in self.discover().fields])} FROM {self.table}{self.where(predicates)}"
        if self.o.get("order_by"):
            q += f" ORDER BY {self.o['order_by']}"
        if self.limit is not None:
            q += f" LIMIT {self.limit}"
        return {"path": self._path("query"), "query": {"q": q}}

    def rows(self, answer):
        return [{k: v for k, v in r.items() if k != "attributes"} for r in answer["records"]]

    def following(self, answer, asked, got):
        return None if answer.get("done", True) else {"path": answer["nextRecordsUrl"]}

    def discover(self):
        fields = self.client.get(self._path(f"sobjects/{self.table}/describe"))["fields"]
        return T.StructType([T.StructField(f["name"], self.TYPES.get(f["type"], T.StringType)(), f.get("nillable", True)) for f in fields])

    def tables(self):
        return sorted(x["name"] for x in self.client.get(self._path("sobjects"))["sobjects"])

    def aggregate_request(self, predicates, group_by, measures):
        """The request for groups, which come page by page with measures named m0, m1 and so on."""
        if any(filters.soql(p) is None for p in predicates):
            return None
        said = ", ".join([*group_by, *(f"{f.upper()}({c if f != 'count' or c else ''}) m{i}" for i, (f, c, _) in enumerate(measures))])
        q = f"SELECT {said} FROM {self.table}{self.where(predicates)}" + (f" GROUP BY {', '.join(group_by)}" if group_by else "")
        return {"path": self._path("query"), "query": {"q": q}}

    def aggregate(self, predicates, group_by, measures):
        asked, out = self.aggregate_request(predicates, group_by, measures), []
        if asked is None:
            return None
        while asked is not None:
            answer = self.send(asked)
            out += [[*(r.get(k) for k in group_by), *(r.get(f"m{i}") for i in range(len(measures)))] for r in answer["records"]]
            asked = self.following(answer, asked, 0)
        return out

    def insert(self, record):
        return self.client.request("POST", self._path(f"sobjects/{self.table}"), body=record)

    def update(self, key, changes):
        return self.client.request("PATCH", self._path(f"sobjects/{self.table}/{key}"), body=changes)

    def delete(self, key):
        return self.client.request("DELETE", self._path(f"sobjects/{self.table}/{key}"))

    def bulk_insert(self, columns: list[str], csv: str, poll: float = 2.0, tries: int = 300) -> dict:
        """A bulk job: create, upload, close, poll; aborted on an error."""
        import time

        job = self.client.request("POST", self._path("jobs/ingest"), body={"object": self.table, "operation": "insert", "contentType": "CSV", "lineEnding": "LF"})
        try:
            self.client.request("PUT", self._path(f"jobs/ingest/{job['id']}/batches"), body=csv.encode(), content="text/csv")
            self.client.request("PATCH", self._path(f"jobs/ingest/{job['id']}"), body={"state": "UploadComplete"})
            for _ in range(tries):
                state = self.client.get(self._path(f"jobs/ingest/{job['id']}"))
                if state["state"] == "JobComplete":
                    return state
                if state["state"] in ("Failed", "Aborted"):
                    raise QueryError(f"bulk job {state['state']}")
                time.sleep(poll)
            raise QueryError("the bulk job did not end in time")
        except Exception:
            self.client.request("PATCH", self._path(f"jobs/ingest/{job['id']}"), body={"state": "Aborted"})
            raise


class SalesforceSource(_Source):
    api = Salesforce

    @classmethod
    def name(cls):
        return "fedspark_salesforce"


class Jira(Api):
    """Issues by JQL, and the flat lists of a Jira site."""

    keys = ("key", "id")
    page_size = 100
    FLAT = {"project": "project/search", "projects": "project/search", "user": "users/search", "users": "users/search", "status": "status", "priority": "priority", "issuetype": "issuetype", "field": "field"}

    def __init__(self, options, known=None):
        super().__init__(options, known)
        if self.table not in self.FLAT:
            self.size = min(self.size, 100)  # a site gives no more issues at once

    def _body(self, predicates, columns, offset, size):
        said = " AND ".join(t for t in map(filters.jql, predicates) if t)
        order = self.o.get("order_by") or "key"
        body = {"jql": f"{said} ORDER BY {order}".strip(), "startAt": offset, "maxResults": size}
        if columns:
            body["fields"] = [c for c in columns if c not in ("id", "key", "self")]
        return body

    def request(self, predicates, columns, offset, size):
        if self.table in self.FLAT:
            return {"path": f"rest/api/3/{self.FLAT[self.table]}", "query": {"startAt": offset, "maxResults": size}}
        return {"method": "POST", "path": "rest/api/3/search", "body": self._body(predicates, columns, offset, size)}

    def rows(self, answer):
        if self.table in self.FLAT:
            return answer if isinstance(answer, list) else answer.get("values", [])
        return [{**{k: i.get(k) for k in ("id", "key", "self")}, **(i.get("fields") or {})} for i in answer["issues"]]

    def total(self, predicates):
        if self.table in self.FLAT:
            return None
        return int(self.send({"method": "POST", "path": "rest/api/3/search", "body": self._body(predicates, ["key"], 0, 1)})["total"])

    def following(self, answer, asked, got):
        if self.table not in self.FLAT:  # a site may give fewer than asked
            b = asked["body"]
            return {**asked, "body": {**b, "startAt": b["startAt"] + got, "maxResults": b["maxResults"] - got}} if got else None
        if isinstance(answer, dict) and not answer.get("isLast", True) and got:
            q = asked["query"]
            return {**asked, "query": {**q, "startAt": int(q["startAt"]) + got}}
        return None

    def tables(self):
        return ["issues", *sorted(set(self.FLAT) - {"project", "user"})]

    def insert(self, record):
        return self.client.request("POST", "rest/api/3/issue", body={"fields": {k: v for k, v in record.items() if k not in ("id", "key", "self")}})

    def update(self, key, changes):
        return self.client.request("PUT", f"rest/api/3/issue/{key}", body={"fields": changes})

    def delete(self, key):
        return self.client.request("DELETE", f"rest/api/3/issue/{key}")


class JiraSource(_Source):
    api = Jira

    @classmethod
    def name(cls):
        return "fedspark_jira"


KINDS = {"rest": RestSource, "servicenow": ServiceNowSource, "salesforce": SalesforceSource, "jira": JiraSource}
