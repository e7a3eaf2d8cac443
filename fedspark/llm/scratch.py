"""Intermediate tables in the folder that all executors share.

A table that several later steps read, or that cuts a long lineage, is written
once as Parquet below ``spark.checkpoint.dir`` and read back.  A lost executor
then costs a re-read, not a recomputation, and nothing depends on local disks.

Tables stay as long as their readers may need them: until their owner sweeps them, or
the application ends.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .. import workdir

_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)
#: (application, owner): paths.
_WRITTEN: dict[tuple[str, str | None], list[str]] = {}

shared_dir = workdir.shared


@contextmanager
def owned(by: str) -> Iterator[None]:
    """Tables written within belong to ``by``."""
    token = _OWNER.set(by)
    try:
        yield
    finally:
        _OWNER.reset(token)


def table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it."""
    path = workdir.fresh(spark, f"fedspark-{name}")
    df.write.option("compression", "zstd").parquet(path)
    if not _WRITTEN:
        atexit.register(_at_exit)
    _WRITTEN.setdefault((spark.sparkContext.applicationId, _OWNER.get()), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, by: str) -> None:
    """Delete the tables that belong to ``by``; call it only when their readers are done."""
    for path in _WRITTEN.pop((spark.sparkContext.applicationId, by), []):
        workdir.delete(spark, path)


def _at_exit() -> None:
    """Delete what the application in this process has left, if it still runs."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    for app, by in [k for k in _WRITTEN if k[0] == spark.sparkContext.applicationId]:
        for path in _WRITTEN.pop((app, by)):
            workdir.delete(spark, path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that the session deals a shuffle into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
