"""Changes of a table by a sync column.

Progress is a pair (time, key), so rows that share a time are neither lost nor read
twice across batches.  Streams use Structured Streaming's checkpoint as their state.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class ChangeConfig:
    """How a table is polled."""

    sync_column: str = "sys_updated_on"
    key_column: str = "sys_id"
    created_column: str | None = None
    deleted_column: str | None = None
    poll_seconds: float = 5.0
    batch_size: int | None = 100
    include_data: bool = True
    since: object = None
    filters: list[str] = field(default_factory=list)

    def __post_init__(self):
        if self.batch_size is not None and not 1 <= self.batch_size <= 10_000:
            raise ValueError("batch_size must lie in 1..10000")
        if self.poll_seconds <= 0:
            raise ValueError("poll_seconds must be positive")


#: Sync and key columns of the known sources.
DEFAULTS = {
    "servicenow": ChangeConfig("sys_updated_on", "sys_id", "sys_created_on"),
    "salesforce": ChangeConfig("LastModifiedDate", "Id", "CreatedDate", "IsDeleted"),
    "jira": ChangeConfig("updated", "key", "created"),
}


def classify(config: ChangeConfig) -> Column:
    """insert, update, delete or unknown."""
    out = F.lit("unknown")
    if config.created_column:
        created, changed = F.col(config.created_column), F.col(config.sync_column)
        out = F.when(created.isNull() | changed.isNull(), F.lit("unknown")).when(created == changed, F.lit("insert")).otherwise(F.lit("update"))
    if config.deleted_column:
        out = F.when(F.coalesce(F.col(config.deleted_column).cast("boolean"), F.lit(False)), F.lit("delete")).otherwise(out)
    return out


def parse_time(c: str | Column) -> Column:
    """A timestamp, or null where the text is none (never the current time)."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def changes_since(table: DataFrame, config: ChangeConfig, since=None, after_key=None, limit: int | None = None) -> DataFrame:
    """Change rows after (since, after_key) in order of (sync column, key): ``limit`` or a batch of
    them, all where ``batch_size`` is None."""
    sync, key = F.col(config.sync_column), F.col(config.key_column)
    out = table
    for f in config.filters:
        out = out.where(f)
    since = config.since if since is None else since
    if since is not None:
        later = sync > F.lit(since)
        if after_key is not None:
            later = later | ((sync == F.lit(since)) & (key > F.lit(after_key)))
        out = out.where(later)
    columns = [classify(config).alias("operation"), key.cast("string").alias("key"), sync.alias("changed_at")]
    if config.include_data:
        columns.append(F.to_json(F.struct(*[F.col(c) for c in table.columns])).alias("data"))
    out, most = out.orderBy(sync, key), config.batch_size if limit is None else limit
    return (out if most is None else out.limit(most)).select(*columns)


def drain(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Handle all that is there now, then stop; a later call goes on from the checkpoint."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def watch_changes(stream: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, poll_seconds: float = 5.0, stop_after: int | None = None):
    """Call back for each batch; stops by itself after ``stop_after`` rows.  Returns the query."""
    seen = [0]

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        seen[0] += batch.count()
        callback(batch, number)
        batch.unpersist()

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=f"{poll_seconds} seconds").start()
    if stop_after is not None:
        while query.isActive and seen[0] < stop_after:
            time.sleep(min(0.2, poll_seconds))
        query.stop()
    return query


def collect_changes(stream: DataFrame, seconds: float, path: str, checkpoint: str) -> DataFrame:
    """What arrives within ``seconds``, written to ``path`` and read back."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
    query.awaitTermination(int(seconds))
    query.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
