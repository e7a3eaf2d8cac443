"""A folder that driver and executors share, for files the engine writes."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        _OWN[app] = tempfile.mkdtemp(prefix="fedspark-work-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return "file://" + _OWN[app]


def fresh(spark: SparkSession, name: str) -> str:
    """A path that nothing has used."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    return fs.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so readers see all or nothing."""
    fs, where = filesystem(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"cannot rename {part.toString()}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = filesystem(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
