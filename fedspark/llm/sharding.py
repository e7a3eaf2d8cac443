"""Sharding by a Feistel permutation over global row numbers.

Rows are numbered 0 to N - 1 by (doc_id, text checksum, size); the number is put
through a keyed permutation of 0 to N - 1; place p goes to shard p mod S, slot
p div S.  The order is a reproducible shuffle, counts differ by one at most (law
``rows``), slots have no gaps, and where a row is, or which row is at a place, can
be computed from N, S and the key without any table.

The permutation is a balanced Feistel network on the least even number of bits
that holds N, walked in cycles: a place beyond N - 1 is permuted again until it
falls inside (fewer than four times on average).

Global numbers come from one range shuffle of narrow rows (24 bytes; texts stay
where they are): rows are sorted inside partitions, counted per partition, and the
counts before a partition - one number for each - are added.

Defined cases: a null text has size 16 and checksum 0; null doc_ids come first;
rows that are equal in all three sort keys get neighbouring numbers in either
order (they are equal in the result but for the place); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

SHARDS = 40
KEY = 20240607
ROUNDS = 6
_U64 = np.uint64


def half_bits(n: int) -> int:
    """Bits of each half of the network that covers 0 to n - 1."""
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def _round(half: np.ndarray, round_number: int, key: int) -> np.ndarray:
    h = half + _U64((key * 0x9E3779B97F4A7C15 + round_number * 0xD1B54A32D192ED03) & (2**64 - 1))
    h = (h ^ (h >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


def _network(x: np.ndarray, bits: int, key: int, back: bool) -> np.ndarray:
    mask = _U64((1 << bits) - 1)
    left, right = x >> _U64(bits), x & mask
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ (_round(left, r, key) & mask), left
        else:
            left, right = right, left ^ (_round(right, r, key) & mask)
    return (left << _U64(bits)) | right


def permute(numbers: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The place of each row number below ``n``; with ``back`` the number at each place."""
    x = np.asarray(numbers, dtype=np.uint64)
    if n <= 1:
        return x.copy()
    bits = half_bits(n)
    x = _network(x, bits, key, back)
    out = np.flatnonzero(x >= _U64(n))
    while len(out):  # cycle walking
        x[out] = _network(x[out], bits, key, back)
        out = out[x[out] >= _U64(n)]
    return x


def place(number: int, n: int, shards: int = SHARDS, key: int = KEY) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    p = int(permute(np.array([number]), n, key)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, key: int = KEY) -> int:
    """The row number that stands at a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, key, back=True)[0])


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``number`` (0 to N - 1 by ``order``), and N.  Meant for narrow rows."""
    spark = rows.sparkSession
    parts = scratch.shuffle_width(spark)
    # Written, because a second evaluation could draw other range borders.
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = scratch.table(spark, sorted_rows.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    counts = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, n = [], 0
    for p, c in counts:  # one number a partition
        before.append((p, n))
        n += c
    if not before:
        return stored.select("*", F.lit(0).cast("long").alias("number")).drop("at"), 0
    starts = F.broadcast(spark.createDataFrame(before, "part long, start long"))
    out = stored.withColumn("part", part.cast("long")).join(starts, "part")
    return out.withColumn("number", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "start", "at"), n


def shard(docs: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows, n = numbered(scratch.table(docs.sparkSession, rows, "sizes"), ["doc_id", "text_crc32", "size"])

    def run(batches):
        for batch in batches:
            p = permute(batch.column(3).to_numpy(zero_copy_only=False), n, key)
            at = pa.array((p % _U64(shards)).astype(np.int32)), pa.array((p // _U64(shards)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *at], names=["doc_id", "size", "text_crc32", "shard", "slot"])

    out = rows.select("doc_id", "size", "text_crc32", "number").mapInArrow(run, "doc_id long, size long, text_crc32 long, shard int, slot long")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
