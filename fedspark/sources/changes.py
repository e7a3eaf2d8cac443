"""A stream of changes of a web table.

The offset is a pair (time, key).  A batch holds the rows after one pair up to the
next, so rows of equal time are neither lost nor read twice; the pairs live in the
query's checkpoint.  A row that appears later with the very time of the last pair and
a smaller key is not seen.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from . import auth
from .filters import Predicate


@dataclass
class Between(InputPartition):
    start: dict
    end: dict


class _Changes(DataSourceStreamReader):
    def __init__(self, options):
        self.o = {k.lower(): v for k, v in dict(options).items()}
        self.sync, self.key = self.o["sync_column"], self.o["key_column"]
        # Read here, where the private file is; it goes to the tasks with the reader.
        self.auth = auth.of_file(self.o.get("credential"))

    def _api(self, **more):
        from .api import KINDS

        return KINDS[self.o["kind"]].api({**self.o, **more}, self.auth)

    def _rows(self, api, predicates):
        for page in api.pages(predicates, []):
            yield from api.read(page)

    def initialOffset(self):
        return {"ts": self.o.get("since", ""), "key": ""}

    def latestOffset(self):
        first = self.initialOffset()
        since = [Predicate(self.sync, ">=", first["ts"])] if first["ts"] else []
        newest = next(iter(self._rows(self._api(order_by=f"{self.sync} desc", limit="1", parallel="false"), since)), None)
        if newest is None:
            return first
        ts = str(newest[self.sync])
        keys = [str(r[self.key]) for r in self._rows(self._api(parallel="false"), [Predicate(self.sync, "=", ts)])]
        return {"ts": ts, "key": max(keys, default=str(newest[self.key]))}

    def partitions(self, start, end):
        return [Between(start, end)]

    def read(self, partition):
        lo, hi = ((x["ts"], x["key"]) for x in (partition.start, partition.end))
        asked = [Predicate(self.sync, "<=", hi[0])] + ([Predicate(self.sync, ">=", lo[0])] if lo[0] else [])
        api = self._api(order_by=f"{self.sync}", parallel="false")
        created, deleted = self.o.get("created_column"), self.o.get("deleted_column")
        for r in self._rows(api, asked):
            at = (str(r[self.sync]), str(r[self.key]))
            if not lo < at <= hi:
                continue
            operation = "unknown"
            if created and r.get(created) is not None:
                operation = "insert" if str(r[created]) == at[0] else "update"
            if deleted and str(r.get(deleted)).lower() in ("true", "1"):
                operation = "delete"
            yield operation, at[1], at[0], json.dumps(r, default=str)

    def commit(self, end):
        """The checkpoint keeps the place."""


class ChangeSource(DataSource):
    @classmethod
    def name(cls):
        return "fedspark_changes"

    def schema(self):
        return "operation string, key string, changed_at string, data string"

    def streamReader(self, schema):
        return _Changes(self.options)
