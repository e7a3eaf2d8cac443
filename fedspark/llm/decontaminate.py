"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are lower-cased (A-Z) and runs of white space become one
space.  An item of m characters (code points) is found in a text if some stretch of the
text can be turned into it with at most e = floor(EDITS * m) edits.

* Lemma: such a stretch shares at least t = m - q + 1 - q * e q-grams with the item,
  all on at most e + 1 neighbouring diagonals (place in the text minus place in the
  item).  q is ``Q``, and for short items the largest that makes t 1 at least; so an
  item of under ten characters is found by itself whole.
* Shared q-grams are counted first by text and item, then in diagonal bands of width
  2 (e + 1) that overlap by half, so any e + 1 neighbouring diagonals lie in one band.
  Bands with fewer than t are dropped.  Hits are counted a million at a time.
* A stretch of a text with many more hits than characters (repetitive text against a
  repetitive item) is not counted at all: every diagonal that has a hit in it goes to
  the alignment, so work and memory follow the text, not its square.
* What is left is verified by an alignment confined to its diagonals (and e on either
  side), for many candidates at once.

q-grams are compared by 64-bit hashes; a collision could only bring a candidate more.
The items are the query set.  They are handled in blocks of ``BLOCK_CHARACTERS``, each
in one pass over the texts; a block's q-gram index is broadcast, and texts never move.

Defined cases: null texts, null items and items without a character match nothing; a
null doc_id passes through; equal items are each reported; an empty table gives an empty
result; rows are judged one by one, so repeated rows give equal results; texts of any
length are read whole; extra columns are ignored by ``find`` and kept by ``clean``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb

Q = 8
EDITS = 0.10
#: Characters of benchmark items in one broadcast index (about 40 bytes of index each).
BLOCK_CHARACTERS = 1 << 20
#: Hits that are counted at once; cells of the alignment that are held at once.
HITS, CELLS = 1 << 20, 1 << 18
#: Characters of a stretch, and hits a character beyond which it is not counted.
STRETCH, DENSE = 4096, 8
_BITS = 20
_FAR = 1 << 20
_U64 = np.uint64


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with single spaces, and where each text begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    points = np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)
    blank = ((points >= 9) & (points <= 13)) | (points == 32)
    points[blank] = 32
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    return points[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q code points from each place on (past the end: zeros)."""
    out, done = np.zeros(len(points), dtype=np.uint64), 0
    part, size = points.astype(np.uint64) + _U64(1), 1
    while True:
        if q & size:
            ahead = np.concatenate([part[done:], np.zeros(min(done, len(part)), np.uint64)])
            out = out * _U64(pow(0x9E3779B97F4A7C15, size, 1 << 64)) + ahead
            done += size
        if done == q:
            return out
        ahead = np.concatenate([part[size:], np.zeros(min(size, len(part)), np.uint64)])
        part, size = part * _U64(pow(0x9E3779B97F4A7C15, size, 1 << 64)) + ahead, 2 * size


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (wb.mix(hashes) >> _U64(64 - _BITS)).astype(np.int64)


def budget(m: int) -> tuple[int, int, int]:
    """(e, q, t) of an item of m characters."""
    e = int(EDITS * m)
    q = min(Q, m // (e + 1))
    return e, q, m - q + 1 - q * e


class _Grams:
    """The q-grams of the items that have one q: sorted, with item and place of each."""

    def __init__(self, q: int, items: list[tuple[int, np.ndarray]]):
        self.q = q
        hashes = [grams(p, q)[: len(p) - q + 1] for _, p in items]
        item = np.repeat(np.array([i for i, _ in items], dtype=np.int32), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes])
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.concatenate([first, [len(hashes)]]).astype(np.int64)
        self.item, self.place = item[order], place[order]
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[_bucket(self.hashes)] = True

    def found(self, points: np.ndarray, offsets: np.ndarray):
        """Places in ``points`` of grams of the index, their text, and which gram."""
        hashes = grams(points, self.q)
        at = np.flatnonzero(self.seen[_bucket(hashes)])
        index = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        ok = self.hashes[index] == hashes[at]
        at, index = at[ok], index[ok]
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + self.q <= offsets[text + 1]
        return at[inside], text[inside], index[inside]

    def entries(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For grams one after another: which of them, and the entries of each."""
        n = self.first[index + 1] - self.first[index]
        which = np.repeat(np.arange(len(index)), n)
        return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.first[index], n)


def _totals(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sum of their counts."""
    if len(parts) == 1:
        return parts[0]
    keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(which, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


class Index:
    """q-grams of a block of items (id, text)."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        plain = [normalise([t])[0] for _, t in items]
        plain = [p[int((p[:1] == 32).sum()) : len(p) - int((p[-1:] == 32).sum())] for p in plain]
        self.length = np.array([len(p) for p in plain], dtype=np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.points = np.concatenate([*plain, np.zeros(0, np.uint32)])
        limits = np.array([budget(int(m)) for m in self.length], dtype=np.int64).reshape(-1, 3)
        self.edits, self.q, self.need = limits.T
        self.grams = [_Grams(q, [(i, plain[i]) for i in np.flatnonzero(self.q == q).tolist()]) for q in np.unique(self.q[self.length > 0]).tolist()]

    def matches(self, points: np.ndarray, offsets: np.ndarray):
        """Texts, items, start, end and edits of the best match of each pair in normalised ``points``."""
        strips = [s for g in self.grams for s in self._strips(g, points, offsets)] if len(points) else []
        if not sum(map(len, strips)):
            return [np.zeros(0, dtype=np.int64)] * 5
        return self._verified(points, offsets, np.concatenate(strips))

    def _strips(self, g: _Grams, points, offsets) -> list[np.ndarray]:
        """(text, item, first diagonal, number of diagonals) of all candidates, a row each."""
        at, text, index = g.found(points, offsets)
        if not len(at):
            return []
        n = g.first[index + 1] - g.first[index]
        stretch = (at - offsets[text]) // STRETCH
        edge = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(stretch) != 0)])
        dense = np.add.reduceat(n, edge) > DENSE * STRETCH
        out = []
        for k in np.flatnonzero(dense).tolist():
            a, b = edge[k], edge[k + 1] if k + 1 < len(edge) else len(at)
            item = np.unique(g.item[g.entries(np.unique(index[a:b]))[1]]).astype(np.int64)
            begin = np.full(len(item), stretch[a] * STRETCH)
            out.append(np.stack([np.full(len(item), text[a]), item, begin - self.length[item], STRETCH + self.length[item]], axis=1))
        thin = ~np.repeat(dense, np.diff(np.r_[edge, len(at)]))
        at, text, index, n = at[thin], text[thin], index[thin], n[thin]
        cuts = [0, *(np.searchsorted(np.cumsum(n), np.arange(HITS, int(n.sum()), HITS), "left") + 1).tolist(), len(at)]
        chunks = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        counts = []
        for c in chunks:  # by text and item
            which, entry = g.entries(index[c])
            counts.append(np.unique(text[c][which] * len(self.ids) + g.item[entry], return_counts=True))
        if not counts:
            return out
        pairs, count = _totals(counts)
        pairs = pairs[count >= self.need[pairs % len(self.ids)]]
        if not len(pairs):
            return out
        # Overlapping bands: each diagonal is in two.
        longest = int(self.length.max()) + 1
        reach = longest + int(np.diff(offsets).max()) + 4
        counts = []
        for c in chunks:
            which, entry = g.entries(index[c])
            pair = text[c][which] * len(self.ids) + g.item[entry]
            slot = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            ok = pairs[slot] == pair
            if not ok.any():
                continue
            slot, which, place = slot[ok], which[ok], g.place[entry[ok]].astype(np.int64)
            diagonal = at[c][which] - offsets[text[c][which]] - place
            low = np.floor_divide(diagonal, self.edits[pairs[slot] % len(self.ids)] + 1) + longest + 1
            key = slot * reach + low
            # Each place of the item counts once: repetitive texts hit the same ones again and again.
            spots = np.unique(np.concatenate([key, key - 1]) * longest + np.tile(place, 2))
            counts.append(np.unique(spots // longest, return_counts=True))
        key, count = _totals(counts)
        text, item = np.divmod(pairs[key // reach], len(self.ids))
        ok = count >= self.need[item]
        key, text, item = key[ok], text[ok], item[ok]
        e, low = self.edits[item], key % reach - longest - 1
        out.append(np.stack([text, item, low * (e + 1), 2 * (e + 1)], axis=1))
        return out

    def _verified(self, points, offsets, strips):
        """The best match of each text and item within its strips of diagonals."""
        # Strips of alike size together.
        strips = strips[np.lexsort((strips[:, 2], strips[:, 0], self.length[strips[:, 1]], strips[:, 3]))]
        out, lo = [], 0
        while lo < len(strips):
            widest = strips[lo, 3] + 2 * self.edits[strips[lo, 1]]
            hi = min(len(strips), lo + max(1, int(CELLS // widest)))
            hi = lo + int(np.searchsorted(strips[lo:hi, 3], 2 * strips[lo, 3] + 64, "right"))
            out.append(self._aligned(points, offsets, *strips[lo:hi].T))
            lo = hi
        found = np.concatenate(out)
        found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
        if not len(found):
            return [np.zeros(0, dtype=np.int64)] * 5
        first = np.r_[True, (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)]
        text, item, edits, end = found[first].T
        return text, item, np.maximum(0, end - self.length[item]), end, edits

    def _aligned(self, points, offsets, text, item, diagonal, width) -> np.ndarray:
        """(text, item, edits, end) of strips that hold a match within the budget."""
        m, e = self.length[item], self.edits[item]
        first, width = (diagonal - e).astype(np.int32), (width + 2 * e).astype(np.int32)
        column = np.arange(int(width.max()), dtype=np.int32)
        size = (offsets[text + 1] - offsets[text]).astype(np.int32)
        outside = column >= width[:, None]
        best = np.full(len(text), np.iinfo(np.int32).max, dtype=np.int64)
        end = np.zeros(len(text), dtype=np.int64)
        # Edits so far; a match may start anywhere.
        start = first[:, None] + column
        row = np.where((start >= 0) & (start <= size[:, None]) & ~outside, np.int32(0), np.int32(_FAR))
        for i in range(1, int(m.max()) + 1):
            place = start + np.int32(i - 1)  # character of the text that the cell reads
            inside = (place >= 0) & (place < size[:, None]) & ~outside
            read = points[np.clip(place + offsets[text][:, None], 0, len(points) - 1)]
            letter = self.points[np.minimum(self.offset[item] + i - 1, len(self.points) - 1)]
            across = row + np.where(inside, (read != letter[:, None]).astype(np.int32), np.int32(_FAR))
            drop = np.full_like(row, _FAR)
            drop[:, :-1] = row[:, 1:] + 1
            new = np.minimum(across, drop)
            new = np.minimum.accumulate(new - column, axis=1) + column
            row = np.where(outside | (place < -1) | (place >= size[:, None]), np.int32(_FAR), new)
            done = np.flatnonzero(m == i)
            if len(done):
                k = row[done].argmin(axis=1)
                best[done] = row[done, k]
                end[done] = first[done] + k + i
        ok = best <= e
        return np.stack([text[ok], item[ok], best[ok], end[ok]], axis=1)


def _blocks(items: DataFrame):
    """Blocks of (item_id, text), read one after another."""
    block, held = [], 0
    for r in items.where("text is not null").select(F.col("item_id").cast("long").alias("i"), "text").orderBy("i", "text").toLocalIterator():
        block.append((r["i"], r["text"]))
        held += len(block[-1][1])
        if held >= BLOCK_CHARACTERS:
            yield block
            block, held = [], 0
    if block:
        yield block


def _read(batch, column: int):
    """Rows lo to hi of a batch with their normalised texts, about two MB at a time."""
    _, offsets = wb.utf8(batch.column(column))
    for lo, hi in wb.groups(offsets):
        yield lo, hi, *normalise([t or "" for t in batch.column(column).slice(lo, hi - lo).to_pylist()])


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: one row for each text and item found in it.

    ``start`` (near) and ``end`` are characters of the normalised text.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, start long, end long, edits long"
    out = []
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(Index(block))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                for lo, hi, points, offsets in _read(batch, 1):
                    text, item, *rest = index.matches(points, offsets)
                    if len(text):
                        ids = batch.column(0).slice(lo, hi - lo).take(pa.array(text))
                        yield pa.RecordBatch.from_arrays([ids, pa.array(index.ids[item]), *(pa.array(x.astype(np.int64)) for x in rest)], names=["doc_id", "item_id", "start", "end", "edits"])

        out.append(source.mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, out) if out else spark.createDataFrame([], schema)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns kept, in which no item is found.  One pass a block, no shuffle."""
    for block in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for lo, _, points, offsets in _read(batch, batch.schema.get_field_index("text")):
                    keep[lo + index.matches(points, offsets)[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
