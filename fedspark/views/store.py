"""Materialized views.

A view is a folder with ``v=<n>`` Parquet folders and ``view.json``, which names the
current ones.  A refresh writes new files first and then replaces the pointer in one
rename, so readers see the old rows or the new ones, never a mix, and a folder that is
being read is never overwritten.
"""

from __future__ import annotations

import datetime
import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workdir
from ..errors import QueryError, SchemaError

_NAME = re.compile(r"[A-Za-z_]\w*\Z")
SYNC_COLUMNS = ("sys_updated_on", "LastModifiedDate", "updated", "updated_at")


@dataclass
class View:
    name: str
    sql: str
    strategy: str = "full"
    sync_column: str | None = None
    key_column: str | None = None
    versions: list[str] = field(default_factory=list)
    high_water: str | None = None
    rows: int = 0
    schema: str | None = None
    history: list[dict] = field(default_factory=list)


class ViewStore:
    """Views below ``root``; they are offered to SQL as temporary views of their names."""

    def __init__(self, spark: SparkSession, root: str | None = None, run=None):
        self.spark = spark
        self.root = (root or f"{workdir.shared(spark)}/views").rstrip("/")
        self._run = run or spark.sql
        for name in self.list():
            self._offer(self.get(name))

    # the catalog

    def list(self) -> list[str]:
        return [n for n in workdir.children(self.spark, self.root) if self.exists(n)]

    def exists(self, name: str) -> bool:
        return workdir.exists(self.spark, f"{self.root}/{name}/view.json")

    def get(self, name: str) -> View:
        if not self.exists(name):
            raise QueryError(f"no materialized view {name}", suggestion="create it first")
        return View(**json.loads(workdir.read_text(self.spark, f"{self.root}/{name}/view.json")))

    def stats(self, name: str) -> dict:
        view = self.get(name)
        return {"rows": view.rows, "versions": len(view.versions), "high_water": view.high_water, "refreshes": len(view.history)}

    # create, refresh, drop

    def create(self, name: str, sql: str, strategy: str = "full", sync_column: str | None = None, key_column: str | None = None, if_not_exists: bool = False) -> View:
        if not _NAME.match(name):
            raise QueryError(f"{name!r} is no view name", suggestion="use letters, digits and underscores")
        if self.exists(name):
            if if_not_exists:
                return self.get(name)
            raise QueryError(f"the view {name} exists", suggestion="drop it, or say if_not_exists")
        if strategy not in ("full", "incremental"):
            raise QueryError(f"no strategy {strategy!r}")
        df = self._run(sql)
        if strategy == "incremental":
            sync_column = sync_column or next((c for c in SYNC_COLUMNS if c in df.columns), None)
            if sync_column is None or sync_column not in df.columns:
                raise SchemaError("an incremental view needs a sync column in its result")
        view = View(name, sql, strategy, sync_column, key_column)
        self._write(view, df, "create")
        return view

    def refresh(self, name: str, mode: str | None = None, force_full: bool = False) -> View:
        view = self.get(name)
        mode = "full" if force_full else mode or view.strategy
        if mode == "full" or view.high_water is None:
            self._write(view, self._run(view.sql), "full")
            return view
        if not view.sync_column:
            raise QueryError(f"{name} has no sync column to refresh by")
        # Rows at the mark itself are read again: others may share its time.
        mark = F.lit(view.high_water).cast(self.read(name).schema[view.sync_column].dataType)
        old, new = self.read(name), self._run(view.sql).where(F.col(view.sync_column) >= mark)
        if view.key_column:
            self._write(view, self.upserted(old, self.latest(new, view.key_column, view.sync_column), view.key_column), "upsert")
        else:
            kept = old.where((F.col(view.sync_column) < mark) | F.col(view.sync_column).isNull())
            self._append(view, kept, old, new, mark)
        return view

    def _append(self, view: View, kept: DataFrame, old: DataFrame, new: DataFrame, mark) -> None:
        """Only rows from the mark on are written; older folders stay as they are."""
        at_mark = old.where(F.col(view.sync_column) == mark)
        fresh = new.exceptAll(at_mark)
        path = self._next(view)
        fresh.write.parquet(path)
        view.versions.append(path)
        self._commit(view, "append", since=view.rows)

    @staticmethod
    def latest(new: DataFrame, key: str, sync: str) -> DataFrame:
        """Of new rows of one key the last; rows without a key stay."""
        last = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*new.columns), F.struct(sync, F.xxhash64(*new.columns))).alias("last"))
        return last.select("last.*").unionByName(new.where(F.col(key).isNull()))

    @staticmethod
    def upserted(old: DataFrame, new: DataFrame, key: str, keep_old_where_null: bool = False) -> DataFrame:
        """Old rows replaced by new ones of the same key (the whole row, or its non-null values)."""
        if not keep_old_where_null:
            return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(new)
        o, n = old.alias("o"), new.alias("n")
        return o.join(n, F.expr(f"o.`{key}` = n.`{key}`"), "full").select(*[F.coalesce(F.col(f"n.`{c}`"), F.col(f"o.`{c}`")).alias(c) for c in old.columns])

    def drop(self, name: str, if_exists: bool = False) -> None:
        if not self.exists(name):
            if if_exists:
                return
            raise QueryError(f"no materialized view {name}")
        self.spark.catalog.dropTempView(name)
        workdir.delete(self.spark, f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        view = self.get(name)
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(view.schema))).parquet(*view.versions)

    # storage

    def _next(self, view: View) -> str:
        return f"{self.root}/{view.name}/v={len(view.history) + 1}-{datetime.datetime.now(datetime.UTC):%Y%m%d%H%M%S%f}"

    def _write(self, view: View, df: DataFrame, what: str) -> None:
        path = self._next(view)
        df.write.parquet(path)
        view.versions = [path]
        view.schema = df.schema.json()
        self._commit(view, what)

    def _commit(self, view: View, what: str, since: int = 0) -> None:
        """Count what was written last (on top of ``since`` rows before) and find its mark."""
        from pyspark.sql.types import StructType

        df = self.spark.read.schema(StructType.fromJson(json.loads(view.schema))).parquet(view.versions[-1])
        wanted = [F.count("*").alias("n")] + ([F.max(view.sync_column).cast("string").alias("m")] if view.sync_column else [])
        row = df.agg(*wanted).first()
        view.rows = since + row["n"]
        if view.sync_column and (row["m"] is not None or not since):  # appended rows are none before the mark
            view.high_water = row["m"]
        view.history.append({"mode": what, "rows": view.rows, "at": datetime.datetime.now(datetime.UTC).isoformat()})
        workdir.write_text(self.spark, f"{self.root}/{view.name}/view.json", json.dumps(asdict(view)))
        self._offer(view)

    def _offer(self, view: View) -> None:
        self.read(view.name).createOrReplaceTempView(view.name)
