"""DB-API 2.0 over the engine, and an asynchronous face of it."""

from __future__ import annotations

import asyncio
import re

from .engine import Engine
from .errors import EngineError, QueryError

apilevel, threadsafety, paramstyle = "2.0", 1, "qmark"
Error = EngineError


class Cursor:
    def __init__(self, connection: Connection):
        self.connection, self.arraysize = connection, 1
        self.description, self.rowcount = None, -1
        self._df, self._rows, self.closed = None, None, False

    def _open(self):
        if self.closed or self.connection.closed:
            raise QueryError("the cursor is closed")

    def execute(self, sql: str, parameters=None) -> Cursor:
        self._open()
        self._df = self.connection.engine.sql(sql, args=list(parameters) if parameters is not None else None)
        self._rows, self.rowcount = None, -1
        self.description = [(f.name, f.dataType.simpleString(), None, None, None, None, f.nullable) for f in self._df.schema.fields]
        if self._df.columns == ["num_affected_rows"]:
            self.rowcount = self._df.first()[0]
        return self

    def executemany(self, sql: str, sets) -> Cursor:
        """INSERT of many rows is one write; other statements run one by one."""
        self._open()
        sets = [tuple(s) for s in sets]
        m = re.match(r"\s*INSERT\s+INTO\s+`?\"?(\w+)`?\"?\.`?\"?(\w+)`?\"?\s*(?:\(([^)]*)\))?\s*VALUES\s*\(\s*\?(?:\s*,\s*\?)*\s*\)\s*;?\s*\Z", sql, re.I)
        if m:
            columns = [c.strip(" `\"") for c in m[3].split(",")] if m[3] else None
            self.rowcount = self.connection.engine.insert_many(m[1], m[2], sets, columns)
            return self
        total = 0
        for s in sets:
            self.execute(sql, s)
            total += max(0, self.rowcount)
        self.rowcount = total
        return self

    def _iter(self):
        if self._df is None:
            raise QueryError("nothing was executed")
        if self._rows is None:
            self._rows = self._df.toLocalIterator()
        return self._rows

    def fetchone(self):
        self._open()
        row = next(self._iter(), None)
        return None if row is None else tuple(row)

    def fetchmany(self, size: int | None = None) -> list[tuple]:
        out = []
        for _ in range(size or self.arraysize):
            row = self.fetchone()
            if row is None:
                break
            out.append(row)
        return out

    def fetchall(self) -> list[tuple]:
        self._open()
        return [tuple(r) for r in self._iter()]

    def __iter__(self):
        return iter(self.fetchone, None)

    def to_df(self):
        """The Spark DataFrame, not run."""
        return self._df

    def to_arrow(self):
        return self._df.toArrow()

    def to_pandas(self):
        return self._df.toPandas()

    def close(self):
        self.closed = True

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


class Connection:
    def __init__(self, engine: Engine):
        self.engine, self.closed = engine, False

    def cursor(self) -> Cursor:
        if self.closed:
            raise QueryError("the connection is closed")
        return Cursor(self)

    def execute(self, sql: str, parameters=None) -> Cursor:
        return self.cursor().execute(sql, parameters)

    def commit(self):
        """Nothing to do: writes are final."""

    rollback = commit

    def ping(self) -> bool:
        return not self.closed and self.execute("SELECT 1").fetchone() == (1,)

    def close(self):
        self.closed = True

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


class AsyncCursor:
    """The same calls, awaited; each runs in a thread."""

    def __init__(self, cursor: Cursor):
        self._cursor = cursor

    async def execute(self, sql, parameters=None):
        await asyncio.to_thread(self._cursor.execute, sql, parameters)
        return self

    async def fetchone(self):
        return await asyncio.to_thread(self._cursor.fetchone)

    async def fetchmany(self, size=None):
        return await asyncio.to_thread(self._cursor.fetchmany, size)

    async def fetchall(self):
        return await asyncio.to_thread(self._cursor.fetchall)

    async def to_arrow(self):
        return await asyncio.to_thread(self._cursor.to_arrow)

    async def __aenter__(self):
        return self

    async def __aexit__(self, *_):
        self._cursor.close()


class AsyncConnection:
    def __init__(self, connection: Connection):
        self._connection = connection

    def cursor(self) -> AsyncCursor:
        return AsyncCursor(self._connection.cursor())

    async def close(self):
        self._connection.close()

    async def __aenter__(self):
        return self

    async def __aexit__(self, *_):
        await self.close()
