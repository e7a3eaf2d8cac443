"""Differences between schemas, evolution under a policy, and a cache with expiry."""

from __future__ import annotations

import hashlib
import json
import threading
import time
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..errors import EvolutionError
from .infer import merge_types


@dataclass
class Diff:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    changed: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.changed)


def diff(old: T.StructType, new: T.StructType) -> Diff:
    a, b = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    return Diff(sorted(b.keys() - a.keys()), sorted(a.keys() - b.keys()), {n: (a[n].simpleString(), b[n].simpleString()) for n in sorted(a.keys() & b.keys()) if a[n] != b[n]})


def evolve(old: T.StructType, new: T.StructType, policy: str = "merge", merge: bool = True) -> T.StructType:
    """``merge``: the union, with merged (or the old) types; ``replace``: the new one; ``strict``: an error if they differ."""
    if policy == "replace":
        return new
    change = diff(old, new)
    if policy == "strict":
        if change:
            raise EvolutionError("the schema has changed", suggestion="refresh it, or allow merging", added=change.added, removed=change.removed, changed=sorted(change.changed))
        return old
    if policy != "merge":
        raise EvolutionError(f"no policy {policy!r}")
    b = {f.name: f.dataType for f in new.fields}
    out = [T.StructField(f.name, merge_types(f.dataType, b.get(f.name, T.NullType())) if merge else f.dataType) for f in old.fields]
    return T.StructType(out + [f for f in new.fields if f.name in set(change.added)])


def fingerprint(schema: T.StructType) -> str:
    return hashlib.md5("|".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields)).encode()).hexdigest()


class SchemaCache:
    """(source, table) to schema, whole (structs and arrays included), until it is too old."""

    def __init__(self, ttl: float = 3600.0, clock=time.time):
        self.ttl, self._clock, self._lock = ttl, clock, threading.Lock()
        self._held: dict[tuple[str, str], tuple[float, float, str]] = {}

    def put(self, source: str, table: str, schema: T.StructType, ttl: float | None = None) -> None:
        with self._lock:
            self._held[source, table] = (self._clock(), self.ttl if ttl is None else ttl, schema.json())

    def get(self, source: str, table: str) -> T.StructType | None:
        with self._lock:
            got = self._held.get((source, table))
            if got is None:
                return None
            if self._clock() - got[0] > got[1]:
                del self._held[source, table]
                return None
        return T.StructType.fromJson(json.loads(got[2]))

    def tables(self, source: str | None = None) -> list[tuple[str, str]]:
        with self._lock:
            return sorted(k for k in self._held if source in (None, k[0]))

    def invalidate(self, source: str | None = None, table: str | None = None) -> int:
        with self._lock:
            gone = [k for k in self._held if source in (None, k[0]) and table in (None, k[1])]
            for k in gone:
                del self._held[k]
            return len(gone)
