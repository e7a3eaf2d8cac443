"""Connections kept open, tokens renewed in a scan, values of bodies, the SQLAlchemy address."""

import datetime
import decimal
import json
import pickle
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from fedspark.errors import AuthError
from fedspark.operators import salted_join
from fedspark.sources import http
from fedspark.sources.auth import Auth
from fedspark.sqlalchemy import address
from fedspark.views import ViewStore


class Handler(BaseHTTPRequestHandler):
    protocol_version = "HTTP/1.1"
    tokens = 0

    def log_message(self, *_):
        pass

    def answer(self, status, body, **headers):
        data = json.dumps(body).encode()
        self.send_response(status)
        for k, v in headers.items():
            self.send_header(k, v)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def do_POST(self):
        raw = self.rfile.read(int(self.headers["Content-Length"]))
        if self.path == "/token":
            type(self).tokens += 1
            return self.answer(200, {"access_token": f"t{self.tokens}", "expires_in": 3600})
        return self.answer(200, json.loads(raw))

    def do_GET(self):
        if self.path == "/moved":
            return self.answer(302, {}, Location="/free")
        if self.path == "/drop":
            self.close_connection = True
            return self.answer(200, {"ok": 1})
        if self.path == "/guarded" and self.headers.get("Authorization") != "Bearer t2":
            return self.answer(401, {})
        return self.answer(200, {"ok": 1})


@pytest.fixture(scope="module")
def base():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    server.daemon_threads = True
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}"
    server.shutdown()


def test_connections_are_used_again(base, monkeypatch):
    pool = http.Pool(per_host=1)
    monkeypatch.setattr(http, "POOL", pool)
    client = http.Client(base)
    for path in ("free", "free", "drop", "free", "moved"):
        assert client.get(path) == {"ok": 1}
    assert (pool.made, pool.reused) == (1, 5) or pool.reused >= 4
    assert sum(map(len, pool.kept.values())) <= 1
    now = [0.0]
    aged = http.Pool(idle=10, clock=lambda: now[0])
    monkeypatch.setattr(http, "POOL", aged)
    client.get("free")
    now[0] = 11.0
    client.get("free")
    assert (aged.made, aged.reused) == (2, 0)


def test_a_refused_token_is_renewed_where_the_scan_runs(base):
    auth = Auth({"oauth_token_url": f"{base}/token", "oauth_client_id": "a", "oauth_client_secret": "b"})
    client = pickle.loads(pickle.dumps(http.Client(base, auth=auth)))
    assert client.get("guarded") == {"ok": 1}  # t1 is refused, t2 is not
    with pytest.raises(AuthError):
        http.Client(base, auth=Auth({"token": "x"})).get("guarded")


def test_values_that_json_lacks(base):
    got = http.Client(base).request("POST", "echo", body={"a": decimal.Decimal("-1.5"), "b": datetime.date(2024, 1, 2), "c": None})
    assert got == {"a": -1.5, "b": "2024-01-02", "c": None}


def test_sqlalchemy_address():
    assert address("fedspark+servicenow", "h", 8080, None, "u@x", "p", {"insecure": "true"}) == ("servicenow://u%40x:p@h:8080/", "source", {"insecure": "true"})
    assert address("fedspark", None, None, "data/dir", None, None, {"database": "d"}) == ("file:///data/dir", "d", {})


def test_salts_hang_on_rows_alone(spark):
    left = spark.range(1000).selectExpr("1 as k", "id as v")
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    assert salted_join(left, right, ["k"], 5).count() == 1000
    assert salted_join(left, right, ["k"], 5)._jdf.queryExecution().optimizedPlan().toString().count("rand(") == 0


def test_two_new_rows_of_one_key(spark):
    new = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "c", 1), (None, "d", 1)], "k int, v string, at int")
    got = sorted(map(tuple, ViewStore.latest(new, "k", "at").collect()), key=str)
    assert got == [(1, "b", 7), (2, "c", 1), (None, "d", 1)]
