"""HTTP with retries: 5 tries, 1 s doubling up to 60 s with 25 % jitter, Retry-After honoured.

Connections are kept open and used again: up to ``PER_HOST`` a host and ``IN_ALL`` in a
process, for ``IDLE`` seconds.
"""

from __future__ import annotations

import decimal
import http.client
import json
import random
import threading
import time
import urllib.parse
from dataclasses import dataclass

from ..errors import ConnectionFailed, of_status


@dataclass
class Retry:
    tries: int = 5
    base: float = 1.0
    cap: float = 60.0
    jitter: float = 0.25
    statuses: tuple = (429, 503)

    def wait(self, attempt: int, after: str | None = None) -> float:
        if after:
            try:
                return min(self.cap, max(0.0, float(after)))
            except ValueError:
                pass
        return min(self.cap, self.base * 2**attempt) * (1 + random.uniform(-self.jitter, self.jitter))


PER_HOST, IN_ALL, IDLE = 10, 100, 300.0


class Pool:
    """Idle connections of this process by (scheme, host)."""

    def __init__(self, per_host: int = PER_HOST, in_all: int = IN_ALL, idle: float = IDLE, clock=time.monotonic):
        self.per_host, self.in_all, self.idle, self.clock = per_host, in_all, idle, clock
        self.lock, self.kept, self.made, self.reused = threading.Lock(), {}, 0, 0

    def take(self, scheme: str, host: str, timeout: float):
        """A connection, and whether it was used before."""
        with self.lock:
            while self.kept.get((scheme, host)):
                since, found = self.kept[scheme, host].pop()
                if self.clock() - since < self.idle:
                    self.reused += 1
                    if found.sock is not None:
                        found.sock.settimeout(timeout)
                    return found, True
                found.close()
            self.made += 1
        return {"http": http.client.HTTPConnection, "https": http.client.HTTPSConnection}[scheme](host, timeout=timeout), False

    def give(self, scheme: str, host: str, connection) -> None:
        with self.lock:
            now = self.clock()
            for key, held in list(self.kept.items()):
                for old in [x for x in held if now - x[0] >= self.idle]:
                    held.remove(old)
                    old[1].close()
                if not held:
                    del self.kept[key]
            mine = self.kept.setdefault((scheme, host), [])
            if len(mine) < self.per_host and sum(map(len, self.kept.values())) < self.in_all:
                mine.append((now, connection))
            else:
                connection.close()


POOL = Pool()


def exchange(method: str, url: str, data: bytes | None, headers: dict, timeout: float, pool: Pool | None = None):
    """(status, headers, body) of one request, redirects of reads followed."""
    pool = pool or POOL
    for _ in range(6):
        u = urllib.parse.urlsplit(url)
        while True:
            connection, used = pool.take(u.scheme, u.netloc, timeout)
            try:
                connection.request(method, urllib.parse.urlunsplit(("", "", u.path or "/", u.query, "")), data, headers)
                got = connection.getresponse()
                body = got.read()
                break
            except (http.client.HTTPException, OSError) as e:
                connection.close()
                # An idle connection may have been closed at the other end before it took the request.
                if not used or isinstance(e, TimeoutError):
                    raise
        if got.will_close:
            connection.close()
        else:
            pool.give(u.scheme, u.netloc, connection)
        if method == "GET" and got.status in (301, 302, 303, 307, 308) and got.headers.get("Location"):
            further = urllib.parse.urljoin(url, got.headers["Location"])
            if urllib.parse.urlsplit(further).netloc != u.netloc:  # what stands for us here is no business of others
                headers = {k: v for k, v in headers.items() if k.lower() in ("accept", "content-type")}
            url = further
            continue
        return got.status, got.headers, body
    raise http.client.HTTPException("too many redirects")


def _plain(v):
    """Values that JSON lacks: numbers with a fixed point, dates and times."""
    return float(v) if isinstance(v, decimal.Decimal) else v.isoformat() if hasattr(v, "isoformat") else str(v)


class Client:
    """Requests to one base address; picklable, so partitions can carry it.

    With ``auth``, headers are asked for at each request, so a token that runs out during
    a scan is renewed where the scan runs; one that is refused is renewed once.
    """

    def __init__(self, base: str, headers: dict | None = None, parameters: dict | None = None, timeout: float = 30.0, retry: Retry | None = None, auth=None):
        self.base, self.headers, self.parameters = base.rstrip("/"), headers or {}, parameters or {}
        self.timeout, self.retry, self.auth = timeout, retry or Retry(), auth

    def request(self, method: str, path: str, query: dict | None = None, body=None, raw: bool = False, content: str = "application/json"):
        url = path if path.startswith("http") else f"{self.base}/{path.lstrip('/')}"
        query = {k: v for k, v in {**self.parameters, **(query or {})}.items() if v is not None}
        if query:
            url += ("&" if "?" in url else "?") + urllib.parse.urlencode(query)
        data = None if body is None else body if isinstance(body, bytes) else json.dumps(body, default=_plain).encode()
        attempt, renewed = 0, False
        while True:
            own = self.auth.headers() if self.auth else {}
            headers = {"Accept": "application/json", **({"Content-Type": content} if data is not None else {}), **self.headers, **own}
            try:
                status, told, text = exchange(method, url, data, headers, self.timeout)
            except (http.client.HTTPException, OSError) as e:
                if attempt + 1 < self.retry.tries:
                    time.sleep(self.retry.wait(attempt))
                    attempt += 1
                    continue
                raise ConnectionFailed(f"cannot reach {url.split('?')[0]}: {e}", suggestion="check the address") from None
            if status < 300:
                return text if raw else json.loads(text) if text else None
            if status == 401 and self.auth and not renewed and self.auth.renew():
                renewed = True
                continue
            if status in self.retry.statuses and attempt + 1 < self.retry.tries:
                time.sleep(self.retry.wait(attempt, told.get("Retry-After")))
                attempt += 1
                continue
            raise of_status(status, f"{method} {url.split('?')[0]} failed: {text[:300].decode('utf-8', 'replace')}")

    def get(self, path: str, **query):
        return self.request("GET", path, query)


def dig(body, path: str | None):
    """The value at a dotted path."""
    for part in (path or "").split("."):
        if part:
            body = body.get(part) if isinstance(body, dict) else None
    return body
