"""Token counts by a two-tier lookup on the map side.

The sentencepiece model's merges never cross from a non-space to a space, so a text
falls apart into pre-tokens (spaces and the non-space run after them) whose token
counts add up.

* First tier: the token counts of the corpus's frequent pre-tokens, in a compact
  open-addressing hash table of at most ``TABLE`` entries, broadcast.  Which ones are
  frequent is found in a pass over all texts: each task keeps a bounded summary of
  its most frequent pre-tokens, and only these summaries are combined.
* Second tier: what the table misses is looked up in a bounded cache of the worker,
  and encoded by the library if it is not there either.

No pre-token of a text is ever shuffled.  Which pre-tokens the table holds changes
speed only: counts are the library's own.

Defined cases: a null text counts as empty (no bytes, no tokens); a null doc_id
passes through; a text with the library's own space mark (U+2581) is encoded whole;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb

TABLE = 1 << 15
TABLE_BITS = 17
#: Pre-tokens that a task keeps while counting, and hands over at its end.
SUMMARY, HANDED = 1 << 16, 1 << 12
#: Entries of a worker's cache; it starts afresh when full.
CACHE = 200_000
LIMIT = 4096
_SPACE = wb.byte_class(lambda b: b != 0x20)
_MARK = "▁".encode()
_U64 = np.uint64
_models: dict[str, object] = {}
_cache: dict[int, int] = {}


def _model(proto: bytes):
    key = hashlib.sha256(proto).hexdigest()
    if key not in _models:
        import sentencepiece

        _models.clear()
        _cache.clear()
        _models[key] = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return _models[key]


def _lengths(model, texts: list[str]) -> list[int]:
    return [len(x) for x in model.encode(texts, num_threads=1)] if texts else []


def _pre_tokens(data: np.ndarray, offsets: np.ndarray):
    """key, start, end and leading spaces (the library's dummy one included) of each pre-token; first of each text."""
    starts, ends, first = wb.spans(data, offsets, _SPACE)
    spaces = np.empty(len(starts), dtype=np.int64)
    spaces[1:] = starts[1:] - ends[:-1]
    has = np.diff(first) > 0
    spaces[first[:-1][has]] = starts[first[:-1][has]] - offsets[:-1][has] + 1
    key = wb.hashes(data, starts, ends) + (spaces - 1).astype(np.uint64) * _U64(0xD1342543DE82EF95)
    return key, starts, ends, spaces, first


def frequent(docs: DataFrame, model_proto: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and token counts of the most frequent pre-tokens of all of ``docs``."""

    def summarise(batches):
        held: dict[int, tuple[int, bytes]] = {}
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = wb.utf8(batch.column(0))
            for lo, hi in wb.groups(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                key, starts, ends, spaces, _ = _pre_tokens(part, at)
                u, where, n = np.unique(key, return_index=True, return_counts=True)
                fresh = np.flatnonzero(n > 1)
                raw = part.tobytes()
                for i in fresh.tolist():
                    k = int(u[i])
                    if k not in held:
                        w = where[i]
                        held[k] = b" " * int(spaces[w] - 1) + raw[starts[w] : ends[w]]
                both = np.concatenate([keys, u[fresh]])
                keys, inverse = np.unique(both, return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([counts, n[fresh]]), len(keys)).astype(np.int64)
                if len(keys) > SUMMARY:
                    top = np.sort(np.argpartition(-counts, SUMMARY // 2)[: SUMMARY // 2])
                    keys, counts = keys[top], counts[top]
                    held = {k: held[k] for k in keys.tolist()}
        top = np.argsort(-counts, kind="stable")[:HANDED]
        if len(top):
            yield pa.RecordBatch.from_arrays([pa.array(wb.signed(keys[top])), pa.array(counts[top]), pa.array([held[k] for k in keys[top].tolist()], pa.binary())], names=["key", "n", "word"])

    rows = docs.select("text").mapInArrow(summarise, "key long, n long, word binary")
    top = rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("word").alias("word")).where("length(word) <= 64").orderBy(F.desc("n"), "key").limit(TABLE).toArrow()
    words = [w.decode("utf-8", "replace") for w in top.column("word").to_pylist()]
    return top.column("key").to_numpy().view(np.uint64), np.array(_lengths(_model(model_proto), words), dtype=np.int64)


def build_table(keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open addressing: slots of keys and of lengths (0: free), and the longest probe."""
    size = 1 << TABLE_BITS
    slots, values, longest = np.zeros(size, np.uint64), np.zeros(size, np.uint16), 1
    for k, n in zip(keys.tolist(), lengths.tolist(), strict=True):
        if not 0 < n < 1 << 16:
            continue
        at, probe = k >> (64 - TABLE_BITS), 1
        while values[at]:
            at, probe = (at + 1) % size, probe + 1
        slots[at], values[at] = k, n
        longest = max(longest, probe)
    return slots, values, longest


def look_up(key: np.ndarray, table) -> np.ndarray:
    """Token counts of pre-tokens in the table; 0 for a miss."""
    slots, values, longest = table
    out = np.zeros(len(key), dtype=np.int64)
    at = (key >> _U64(64 - TABLE_BITS)).astype(np.int64)
    open_ = np.arange(len(key))
    for _ in range(longest):
        s = at[open_]
        value = values[s]
        hit = (slots[s] == key[open_]) & (value > 0)
        out[open_[hit]] = value[hit]
        open_ = open_[~hit & (value > 0)]
        if not len(open_):
            break
        at[open_] = (at[open_] + 1) % len(slots)
    return out


def count_tokens(docs: DataFrame, model_proto: bytes) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model_proto, build_table(*frequent(docs, model_proto))))

    def run(batches):
        proto, table = shared.value
        model = _model(proto)
        for batch in batches:
            data, offsets = wb.utf8(batch.column(1))
            for lo, hi in wb.groups(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                key, starts, ends, spaces, first = _pre_tokens(part, at)
                n = look_up(key, table)
                raw = part.tobytes()
                missed = np.flatnonzero(n == 0)
                u, where, inverse = np.unique(key[missed], return_index=True, return_inverse=True)
                got = np.zeros(len(u), dtype=np.int64)
                ask = []
                for i, k in enumerate(u.tolist()):
                    found = _cache.get(k)
                    if found is None:
                        ask.append(i)
                    else:
                        got[i] = found
                if ask:
                    at_word = missed[where[ask]]
                    words = [" " * (s - 1) + raw[a:b].decode() for a, b, s in zip(starts[at_word].tolist(), ends[at_word].tolist(), spaces[at_word].tolist(), strict=True)]
                    got[ask] = _lengths(model, words)
                    if len(_cache) > CACHE:
                        _cache.clear()
                    _cache.update((k, v) for k, v, w in zip(u[ask].tolist(), got[ask].tolist(), words, strict=True) if len(w) <= 64)
                n[missed] = got[inverse]
                sums = np.concatenate([[0], np.cumsum(n)])
                total = sums[first[1:]] - sums[first[:-1]]
                # Spaces at the end of a text stand alone.
                last = np.where(np.diff(first) > 0, ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, at[:-1] - 1)
                tail = at[1:] - last
                tail = np.where(np.diff(at) > 0, tail, 0)
                for i in np.flatnonzero(tail > 0).tolist():
                    # One space more than the library's dummy one, which a text of spaces alone has too.
                    total[i] += _lengths(model, [" " * int(tail[i] - 1)])[0] if tail[i] > 1 else 1
                if _MARK in raw:
                    for i in range(hi - lo):
                        text = raw[at[i] : at[i + 1]]
                        if _MARK in text:
                            total[i] = _lengths(model, [text.decode()])[0]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at).astype(np.int64)), pa.array(total.astype(np.int64)), pa.array(total > LIMIT)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
