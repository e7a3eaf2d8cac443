"""A small HTTP server that filters and pages for real, and remembers what it was asked."""

import json
import re
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

USERS = [{"id": i, "name": f"user{i}", "role": "admin" if i % 3 == 0 else "guest", "tags": ["a"] * (i % 3), "at": {"city": f"c{i % 4}"}} for i in range(1, 26)]
INCIDENTS = [{"sys_id": f"s{i:03}", "number": f"INC{i}", "priority": i % 4, "active": i % 2 == 0, "caller": f"user{i % 7}", "sys_updated_on": f"2024-01-{i % 28 + 1:02} 00:00:00", "sys_created_on": "2024-01-01 00:00:00"} for i in range(1, 61)]
ACCOUNTS = [{"attributes": {"type": "Account"}, "Id": f"A{i}", "Name": f"Acme {i}", "Type": "Customer" if i % 2 else "Partner", "AnnualRevenue": 100.0 * i} for i in range(1, 13)]
ISSUES = [{"id": str(i), "key": f"P-{i}", "fields": {"summary": f"s{i}", "status": {"name": "Done" if i % 2 else "Open"}, "points": i}} for i in range(1, 151)]


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *_):
        pass

    def answer(self, body, status=200, headers=()):
        data = body if isinstance(body, bytes) else json.dumps(body).encode()
        self.send_response(status)
        for k, v in headers:
            self.send_header(k, v)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def handle_any(self):
        url = urllib.parse.urlsplit(self.path)
        q = dict(urllib.parse.parse_qsl(url.query))
        n = int(self.headers.get("Content-Length") or 0)
        raw = self.rfile.read(n)
        body = json.loads(raw) if raw and "json" in (self.headers.get("Content-Type") or "") else raw.decode()
        with self.server.lock:
            self.server.asked.append((self.command, url.path, q, body, dict(self.headers)))
            if self.server.refuse > 0:
                self.server.refuse -= 1
                return self.answer({}, 429, [("Retry-After", "0")])
        p = url.path
        if p == "/token":
            return self.answer({"access_token": "tok", "expires_in": 3600, "refresh_token": "r2"})
        if p == "/users":
            if self.command == "POST":
                return self.answer({"ok": True})
            rows = [u for u in USERS if all(str(u.get(k)) == v for k, v in q.items() if k in u)]
            at, size = int(q.get("offset", 0)), int(q.get("limit", 1000))
            return self.answer({"data": {"items": rows[at : at + size]}})
        if p.startswith("/users/"):
            return self.answer({"ok": True})
        if p == "/cursor":
            at = int(q.get("cursor", 0))
            return self.answer({"data": USERS[at : at + 10], "next": str(at + 10) if at + 10 < len(USERS) else None})
        if p.startswith("/api/now/table/sys_db_object"):
            return self.answer({"result": [{"name": "incident"}, {"name": "problem"}]})
        if p.startswith("/api/now/attachment/"):
            return self.answer(b"\x00bytes")
        if p.startswith("/api/now/"):
            if self.command != "GET":
                return self.answer({"result": {}})
            rows = self.encoded(INCIDENTS, q.get("sysparm_query", ""))
            if "/stats/" in p:
                groups = {}
                for r in rows:
                    groups.setdefault(tuple(r[g] for g in filter(None, q.get("sysparm_group_by", "").split(","))), []).append(r)
                out = []
                for k, rs in groups.items():
                    stats = {"count": str(len(rs))}
                    for f, fn in (("sum", sum), ("max", max), ("min", min), ("avg", lambda v: sum(v) / len(v))):
                        if q.get(f"sysparm_{f}_fields"):
                            stats[f] = {c: str(fn([r[c] for r in rs])) for c in q[f"sysparm_{f}_fields"].split(",")}
                    out.append({"stats": stats, "groupby_fields": [{"field": g, "value": str(v)} for g, v in zip(q.get("sysparm_group_by", "").split(","), k)]})
                return self.answer({"result": out if q.get("sysparm_group_by") else (out or [{"stats": {"count": "0"}}])[0]})
            at, size = int(q["sysparm_offset"]), int(q["sysparm_limit"])
            keep = q.get("sysparm_fields", "").split(",") if q.get("sysparm_fields") else None
            return self.answer({"result": [{k: v for k, v in r.items() if keep is None or k in keep} for r in rows[at : at + size]]})
        if p.endswith("/sobjects"):
            return self.answer({"sobjects": [{"name": "Account"}]})
        if p.endswith("/describe"):
            return self.answer({"fields": [{"name": "Id", "type": "id", "nillable": False}, {"name": "Name", "type": "string"}, {"name": "Type", "type": "picklist"}, {"name": "AnnualRevenue", "type": "currency"}]})
        if "/jobs/ingest" in p:
            return self.answer({"id": "j1", "state": "JobComplete" if self.command == "GET" else "Open"})
        if "/services/data/" in p and "q" in q:
            m = re.match(r"SELECT (.*?) FROM Account(?: WHERE (.*?))?(?: GROUP BY (\w+))?(?: LIMIT (\d+))?\Z", q["q"])
            rows = [r for r in ACCOUNTS if not m[2] or all(self.soql(r, c) for c in m[2].split(" AND "))]
            if m[3]:
                groups = {}
                for r in rows:
                    groups.setdefault(r[m[3]], []).append(r)
                return self.answer({"done": True, "records": [{m[3]: k, "m0": len(v), "m1": sum(r["AnnualRevenue"] for r in v)} for k, v in groups.items()]})
            rows = rows[: int(m[4])] if m[4] else rows
            return self.answer({"done": len(rows) <= 5, "records": rows[:5], "nextRecordsUrl": "/services/data/next"} if len(rows) > 5 else {"done": True, "records": rows})
        if p == "/services/data/next":
            return self.answer({"done": True, "records": ACCOUNTS[5:]})
        if p.startswith("/services/data/"):
            return self.answer({"id": "new"})
        if p == "/rest/api/3/search":
            rows = [i for i in ISSUES if 'status = "Done"' not in body["jql"] or i["fields"]["status"]["name"] == "Done"]
            m = re.search(r"points > (\d+)", body["jql"])
            rows = [i for i in rows if not m or i["fields"]["points"] > int(m[1])]
            at, size = body["startAt"], body["maxResults"]
            return self.answer({"issues": rows[at : at + size], "total": len(rows), "startAt": at, "maxResults": size})
        if p == "/rest/api/3/project/search":
            return self.answer({"values": [{"id": "1", "key": "P", "name": "Proj"}, {"id": "2", "key": "Q", "name": "Quux"}], "isLast": True})
        if p.startswith("/rest/api/3/issue"):
            return self.answer({})
        return self.answer({"error": "none"}, 404)

    do_GET = do_POST = do_PATCH = do_DELETE = do_PUT = handle_any

    @staticmethod
    def soql(r, c):
        m = re.match(r"(\w+) (=|!=|>|>=|<|<=|IN|LIKE) (.*)", c)
        v = m[3].strip("()")
        if m[2] == "IN":
            return repr(r[m[1]]) in v
        if v == "null":
            return (r[m[1]] is None) == (m[2] == "=")
        if m[2] == "LIKE":
            return re.fullmatch(v.strip("'").replace("%", ".*"), r[m[1]]) is not None
        w = v.strip("'") if v[0] == "'" else float(v)
        return {"=": r[m[1]] == w, "!=": r[m[1]] != w, ">": r[m[1]] > w, ">=": r[m[1]] >= w, "<": r[m[1]] < w, "<=": r[m[1]] <= w}[m[2]]

    @staticmethod
    def encoded(rows, said):
        for part in reversed(said.split("^")):
            if part.startswith("ORDERBY"):
                rows = sorted(rows, key=lambda r: r[part.removeprefix("ORDERBY").removeprefix("DESC")], reverse=part.startswith("ORDERBYDESC"))
        for part in filter(None, said.split("^")):
            if part.startswith("ORDERBY"):
                continue
            if m := re.match(r"(\w+?)IN(.+)", part):
                rows = [r for r in rows if str(r[m[1]]) in m[2].split(",")]
            elif m := re.match(r"(\w+?)(ISNOTEMPTY|ISEMPTY)\Z", part):
                rows = [r for r in rows if (r[m[1]] is None) == (m[2] == "ISEMPTY")]
            elif m := re.match(r"(\w+?)(STARTSWITH|LIKE|ENDSWITH)(.*)", part):
                rows = [r for r in rows if {"STARTSWITH": str(r[m[1]]).startswith(m[3]), "ENDSWITH": str(r[m[1]]).endswith(m[3]), "LIKE": m[3] in str(r[m[1]])}[m[2]]]
            else:
                m = re.match(r"(\w+?)(!=|>=|<=|=|>|<)(.*)", part)
                read = lambda v: v.lower() if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else v
                def ok(r, m=m):
                    a = read(r[m[1]])
                    b = float(m[3]) if isinstance(a, int | float) else m[3].lower()
                    return {"=": a == b, "!=": a != b, ">": a > b, ">=": a >= b, "<": a < b, "<=": a <= b}[m[2]]
                rows = [r for r in rows if ok(r)]
        return rows


class Server:
    def __enter__(self):
        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.http.lock, self.http.asked, self.http.refuse = threading.Lock(), [], 0
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.http.server_address[1]}"
        return self

    def __exit__(self, *_):
        self.http.shutdown()

    def asked(self, *, clear=True):
        out = list(self.http.asked)
        if clear:
            self.http.asked.clear()
        return out
