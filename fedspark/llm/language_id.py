"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are runs of one to three characters (code points) of the lower-cased text,
hashed into ``BUCKETS``.  Training counts them per language in one pass over the
training documents; the counts are combined map-side and the (language, bucket) sums,
which are bounded by languages times ``BUCKETS``, make the log-probability matrix.  It
is broadcast in blocks of ``LANGUAGES`` languages (16 MB each), and documents are scored
in sparse batches: the log-probability rows of a batch's features are gathered and
summed per document.  With more languages a document passes one stage a block, which
hands on the best language so far and the mass of all; any number of languages gives
the same results as one block would.

Training rows are those with a language whose crc32(doc_id as text) mod 3 is not 1;
``lang``, ``source`` and ``doc_id`` play no part in a prediction.

Defined cases: a null text, or one without a letter (``str.isalpha``), is ``und`` with
score 0; so is everything if nothing could be learned; an empty table gives an empty
result; a null doc_id trains nothing and counts as not held out; ties go to the first
language in order of name; repeated rows are counted and judged one by one; texts of
any length are read whole, in pieces; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from . import wordbytes as wb

_BITS = 14
BUCKETS = 1 << _BITS
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Languages of one block of the matrix.
LANGUAGES = 250
#: Characters that are looked at at once.
PIECE = 1 << 18
_WORD = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m[0].isalpha() for m in _WORD.finditer(text))


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and where each begins."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)


def features(points: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each character, for each order (the last ones are shorter)."""
    padded = np.concatenate([points, np.zeros(max(ORDERS), dtype=np.uint32)])
    out, total = [], np.zeros(len(points), dtype=np.uint32)
    for n in range(1, max(ORDERS) + 1):
        total = (total ^ (total >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + padded[n - 1 : n - 1 + len(points)] + np.uint32(1)
        if n in ORDERS:
            h = (total + np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)
            out.append((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - _BITS))
    return out


def _pieces(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """(lo, hi, order, buckets, first, last): of texts lo to hi, the n-grams from first to last of the buckets."""
    for lo, hi in wb.groups(offsets, PIECE):
        for a in range(int(offsets[lo]), int(offsets[hi]), PIECE):
            b = min(a + PIECE, int(offsets[hi]))
            at = np.clip(offsets[lo : hi + 1], a, b) - a
            reach = min(int(offsets[hi]), b + max(ORDERS) - 1)
            ends = np.clip(offsets[lo + 1 : hi + 1], a, reach) - a
            for n, f in zip(ORDERS, features(points[a:reach]), strict=True):
                yield lo, hi, f[: b - a], at[:-1], np.minimum(at[1:], np.maximum(at[:-1], ends - (n - 1)))


def _batches(batch, text: int, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi of a batch with the characters of their texts, about ``size`` bytes at a time."""
    _, offsets = wb.utf8(batch.column(text))
    for lo, hi in wb.groups(offsets, size):
        yield lo, hi, *characters(batch.column(text).slice(lo, hi - lo).to_pylist())


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lo, hi, points, offsets in _batches(batch, 0):
            langs = batch.column(1).slice(lo, hi - lo).to_pylist()
            names = sorted(set(langs))
            place = {x: i for i, x in enumerate(names)}
            own = np.array([place[x] for x in langs], dtype=np.int64)
            total = np.zeros(len(names) * BUCKETS, dtype=np.int64)
            for a, b, f, first, last in _pieces(points, offsets):
                n = last - first
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
                total += np.bincount(np.repeat(own[a:b], n) * BUCKETS + f[inner], minlength=len(total))
            for i, x in enumerate(names):
                if len(sums) >= LANGUAGES and x not in sums:
                    yield from _sums(sums)
                    sums = {}
                sums[x] = sums.get(x, 0) + total[i * BUCKETS : (i + 1) * BUCKETS]
    yield from _sums(sums)


def _sums(sums: dict[str, np.ndarray]):
    for x, v in sums.items():
        at = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(v[at])], names=["lang", "bucket", "n"])


def train(labelled: DataFrame) -> list[tuple[list[str], np.ndarray]]:
    """Blocks of languages in order with their (BUCKETS, languages) log-probabilities, from (text, lang)."""
    summed = labelled.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    summed = scratch.table(labelled.sparkSession, summed, "language_counts")
    langs = sorted(r["lang"] for r in summed.select("lang").distinct().collect())
    blocks = []
    for lo in range(0, len(langs), LANGUAGES):
        names = langs[lo : lo + LANGUAGES]
        table = summed.where(F.col("lang").between(names[0], names[-1])).toArrow()
        place = {x: i for i, x in enumerate(names)}
        counts = np.full((BUCKETS, len(names)), SMOOTHING)
        column = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
        counts[table.column("bucket").to_numpy(), column] += table.column("n").to_numpy()
        blocks.append((names, np.log(counts / counts.sum(axis=0)).astype(np.float32)))
    return blocks


def score_texts(points: np.ndarray, offsets: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """(texts, languages) sums of log-probabilities over the n-grams of each text."""
    out = np.zeros((len(offsets) - 1, matrix.shape[1]))
    for lo, hi, f, first, last in _pieces(points, offsets):
        sums = np.cumsum(matrix[f].astype(np.float64), axis=0)
        sums = np.concatenate([np.zeros((1, matrix.shape[1])), sums])
        out[lo:hi] += sums[last] - sums[first]
    return out


_ANSWER = "doc_id long, held_out boolean, lang_pred string, score double"
_ON_THE_WAY = "doc_id long, held_out boolean, text string, lang_pred string, best double, mass double"


def _stage(rows: DataFrame, block: tuple[list[str], np.ndarray] | None, last: bool) -> DataFrame:
    """``rows`` as of _ON_THE_WAY with one more block of languages tried; the answer after the last one."""
    model = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        names, matrix = model.value or ([], np.zeros((BUCKETS, 0), np.float32))
        for batch in batches:
            for lo, hi, points, offsets in _batches(batch, 2):
                part = batch.slice(lo, hi - lo)
                pred, best, mass = part.column(3).to_pylist(), *(part.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
                if names:
                    sums = score_texts(points, offsets, matrix)
                    top = sums.max(axis=1)
                    most = np.maximum(best, top)
                    mass = mass * np.exp(best - most) + np.exp(sums - most[:, None]).sum(axis=1)
                    won = sums.argmax(axis=1).tolist()
                    pred = [names[w] if b else p for p, b, w in zip(pred, (top > best).tolist(), won, strict=True)]
                    best = most
                if last:
                    known = [p is not None and has_letter(t) for p, t in zip(pred, part.column(2).to_pylist(), strict=True)]
                    score = 1 / np.maximum(mass, 1.0)
                    columns = [pa.array([p if k else "und" for p, k in zip(pred, known, strict=True)], pa.string()), pa.array(np.where(known, score, 0.0))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:2], *columns], names=["doc_id", "held_out", "lang_pred", "score"])
                else:
                    columns = [pa.array(pred, pa.string()), pa.array(best), pa.array(mass)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names=["doc_id", "held_out", "text", "lang_pred", "best", "mass"])

    return rows.mapInArrow(run, _ANSWER if last else _ON_THE_WAY)


def predict(docs: DataFrame, blocks: list[tuple[list[str], np.ndarray]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the posterior) of every row of ``docs``."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    start = [F.lit(None).cast("string").alias("lang_pred"), F.lit(float("-inf")).alias("best"), F.lit(0.0).alias("mass")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text", *start)
    for i, block in enumerate(blocks or [None], 1):
        rows = _stage(rows, block, last=i >= len(blocks))
    return rows


def identify(docs: DataFrame) -> DataFrame:
    """Train on the training share of ``docs`` and predict all of it."""
    training = docs.where("text is not null and lang is not null and doc_id is not null").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    return predict(docs, train(training.select("text", F.col("lang").cast("string").alias("lang"))))
