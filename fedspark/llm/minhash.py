"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

A document's set is its distinct five-word shingles (A-Z lower-cased; a shorter
text is one shingle; no words, no set).  Documents with 100 * |A n B| >= 75 *
|A u B| are linked; components of links are the classes of near-duplicates.

1. One pass hashes the shingles, throws them into ``SLOTS`` bins by their top bits
   and keeps the least of each bin.  Empty bins borrow from a bin drawn by a hash
   of (bin, attempt), repeated until a full one is met (optimal densification).
2. Equal sets are settled by their fingerprints: a map-side combined minimum per
   set.  Only the least doc_id of each set goes on, so a group of exact copies
   costs one row, however large.
3. Slots are cut into 32 bands of 4 and 16 of 8.  A bucket gives one edge from each
   member to its least member (a star), so n members give n - 1 edges, never
   n * (n - 1) / 2.  The wide bands find partners that share a crowded bucket with
   unrelated texts whose common passage filled all four slots; besides, members that
   their centre turns out not to resemble are tried with a second centre of each of
   their buckets, drawn anew in every bucket, and with the member of it that has most
   links so far (the text that joins a group resembles the centres of all its buckets).
4. Edges are confirmed on the full sets.  A centre with many partners is dealt out
   over several tasks (salted by the number of its partners).
5. Least labels travel along confirmed links, with pointer jumping, until nothing
   changes; each round is a written table.
6. What the buckets missed is found by an exact join (``shared_tokens``, ``unmet``):
   a. Of each set the shingles of least hash, ``n - need + 1`` and an eighth of n more,
      go to groups by their hash, packed.  A text with a partner shares more than
      an eighth of ``need`` of them with it; texts that share fewer with all others
      together are done.  Few are left, whatever passages are common.
   b. Of the texts left, full sets are held against each other.  Shingles that only
      texts of one component have can make no new link.  A text keeps the others, rarest
      first, if they are at least ``need``; one of its first ``kept - need + 1`` is
      shared with each partner in the same way (prefix filter).
   c. Texts of different components meet at these.  Lengths, places and parity bitmaps
      of the kept shingles bound what a pair can share; pairs that may share enough are
      confirmed on their full sets, and the links join components as before.  A shingle
      that many texts have first is dealt to cells of pairs of blocks of texts.

So links are exact up to collisions of 64-bit shingle hashes (words of up to seven bytes
have hashes of their own): buckets only save work.

Defined cases: null and empty texts get no shingles, their own doc_id and are
kept; a null doc_id counts as the smallest (component null); rows that share a
doc_id are one node of the graph (they are linked to whatever either is linked to)
and each keeps its own row; an empty table gives an empty result; texts of any length
are read whole, in arrays of 16 bytes a word; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from . import wordbytes as wb

SHINGLE = 5
SLOTS = 128
NARROW, WIDE = 4, 8
#: 100 * |A n B| >= LEAST_PERCENT * |A u B|
LEAST_PERCENT = 75
#: Partners of one centre that one task confirms.
PARTNERS_PER_TASK = 256
#: Of a set's shingles, one in so many is looked at beyond the prefix when texts without a partner are ruled out.
MARGIN = 8
#: Shingles that a task packs at once, and groups of packed shingles for each partition of the texts.
PACKED, GROUPS_PER_PARTITION = 1 << 22, 4
#: Texts of one shingle that meet in one cell at most (by two such blocks), and words of a parity bitmap.
BLOCK, PARITY = 2048, 16
#: Pairs that a task compares at once.
_PAIRS = 1 << 16
_NO_ID = -(1 << 63)
_U64 = np.uint64
_ATTEMPTS = 512


def _probes() -> np.ndarray:
    """(attempt, bin) -> bin to borrow from."""
    attempt, slot = np.meshgrid(np.arange(_ATTEMPTS, dtype=np.uint64), np.arange(SLOTS, dtype=np.uint64), indexing="ij")
    return (wb.mix((attempt << _U64(16)) + slot + _U64(0xC0FFEE)) >> _U64(57)).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends, first = wb.spans(data, offsets, wb.NOT_SPACE)
    words = wb.hashes(data, starts, ends, fold=True)
    five = wb.grams(words, SHINGLE)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= SHINGLE:
            out.append(np.unique(five[lo : hi - SHINGLE + 1]))
        elif hi > lo:
            out.append(np.array([wb.sequence_hash(words[lo:hi])], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, SLOTS) least hashes with densified bins; rows of empty sets are zero."""
    edges = np.arange(SLOTS, dtype=np.uint64) << _U64(57)
    least = np.zeros((len(sets), SLOTS), dtype=np.uint64)
    full = np.zeros((len(sets), SLOTS), dtype=bool)
    for i, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, edges)
            value = s[np.minimum(at, len(s) - 1)]
            full[i] = (at < len(s)) & (value >> _U64(57) == np.arange(SLOTS, dtype=np.uint64))
            least[i] = value
    probes = _probes()
    row, slot = np.nonzero(~full & np.array([len(s) > 0 for s in sets], dtype=bool)[:, None])
    for attempt in range(_ATTEMPTS):
        if not len(row):
            break
        lender = probes[attempt][slot]
        hit = full[row, lender]
        least[row[hit], slot[hit]] = least[row[hit], lender[hit]]
        row, slot = row[~hit], slot[~hit]
    for i in np.unique(row):  # never met a full bin: borrow from the next one
        open_slots = slot[row == i]
        there = np.flatnonzero(full[i])
        least[i, open_slots] = least[i, there[np.searchsorted(there, open_slots) % len(there)]]
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """(texts, 48) keys of the buckets."""
    out = []
    for width in (NARROW, WIDE):
        n = SLOTS // width
        salt = wb.mix(np.arange(n, dtype=np.uint64) + _U64(width * 1000))
        total = np.tile(salt, (len(least), 1))
        for j in range(width):
            total = wb.mix(total + least[:, j::width][:, :n] * _U64(0x9E3779B97F4A7C15))
        out.append(total)
    return np.concatenate(out, axis=1)


def needed(n):
    """Shingles that a text of ``n`` shares with each partner at least."""
    return (LEAST_PERCENT * n + 99) // 100


def _signed_rows(batches):
    for batch in batches:
        data, offsets = wb.utf8(batch.column(1))
        for lo, hi in wb.groups(offsets):
            a, b = offsets[lo], offsets[hi]
            sets = shingle_sets(data[a:b], offsets[lo : hi + 1] - a)
            keys = wb.signed(bands(signatures(sets)))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            one, two = fingerprints(sets)
            firsts = [s[: len(s) - needed(len(s)) + 1 + len(s) // MARGIN] for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(n),
                    pa.array(wb.signed(one)),
                    pa.array(wb.signed(two)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(wb.signed(np.concatenate(firsts)))),
                ],
                names=["rid", "n_shingles", "fp1", "fp2", "bands", "firsts"],
            )
    wb.release()


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    one = np.array([np.sum(wb.mix(s + _U64(1)), dtype=np.uint64) for s in sets], dtype=np.uint64)
    two = np.array([np.sum(wb.mix(s ^ _U64(0x5DEECE66D)), dtype=np.uint64) for s in sets], dtype=np.uint64)
    return one, two


def _planes(a: np.ndarray) -> bytes:
    """All first bytes, all second bytes and so on, which compress better."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def _pack(token: np.ndarray, text: np.ndarray, keys: np.ndarray, idents: np.ndarray) -> bytes:
    """Sorted tokens, the text of each (2 * its place in ``keys``, plus 1 if it is settled), and keys and idents."""
    head = np.array([len(token), len(keys)], dtype=np.int64).tobytes()
    diff = np.diff(token, prepend=_U64(0))
    far = np.diff(keys, prepend=np.int64(0))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(map(_planes, (diff, text.astype(np.uint32), far, idents - keys))))


def _unpack(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    token, text = np.cumsum(_from_planes(raw, np.uint64, n, 16)), _from_planes(raw, np.uint32, n, 16 + 8 * n)
    keys = np.cumsum(_from_planes(raw, np.int64, m, 16 + 12 * n))
    return token, text.astype(np.int64), keys, keys + _from_planes(raw, np.int64, m, 16 + 12 * n + 8 * m)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[len(sorted_values) > 0], sorted_values[1:] != sorted_values[:-1]]))


def _packer(n_groups: int, shift: int, settle: bool):
    """Map side: (key, ident, tokens) to packed groups of tokens.

    With ``settle``, a token that texts of two idents have within one pack is counted
    here for all of them; only two of its rows travel, however many there are.
    """

    def flush(held, pack):
        keys, idents = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        text = np.repeat(np.arange(len(keys)), np.concatenate([h[2] for h in held]))
        token = np.concatenate([h[3] for h in held]) >> _U64(shift)
        order = np.lexsort((idents[text], token)) if settle else np.argsort(token, kind="stable")
        token, text = token[order], text[order]
        known = np.zeros(len(token), dtype=np.int64)
        if settle and len(token):
            start = _runs(token)
            size = np.diff(np.r_[start, len(token)])
            last = start + size - 1
            both = np.repeat(idents[text[start]] < idents[text[last]], size)
            count = np.bincount(text[both], minlength=len(keys))
            at = np.flatnonzero(count)
            if len(at):
                yield pack % n_groups, 1, _tally(*_summed_keys(keys[at], count[at]))
            stay = ~both
            stay[start] = stay[last] = True
            token, text, known = token[stay], text[stay], both[stay].astype(np.int64)
        group = (wb.mix(token + _U64(0x632BE59B)) % _U64(n_groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(n_groups + 1))
        rank = np.argsort(np.argsort(keys, kind="stable"), kind="stable")
        by_key = np.argsort(keys, kind="stable")
        for g in np.flatnonzero(np.diff(edges)).tolist():
            here = order[edges[g] : edges[g + 1]]
            used, local = np.unique(rank[text[here]], return_inverse=True)
            yield g, 0, _pack(token[here], 2 * local + known[here], keys[by_key[used]], idents[by_key[used]])

    def out(held, pack):
        rows = list(flush(held, pack))
        for lo in range(0, len(rows), 64):
            g, k, b = zip(*rows[lo : lo + 64], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(k, pa.int8()), pa.array([pack] * len(g), pa.int64()), pa.array(b, pa.binary())], names=["grp", "kind", "pack", "blob"])

    def run(batches):
        held, size, pack = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column(2)
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi in wb.groups(np.r_[0, np.cumsum(n)], PACKED):
                edge = np.r_[0, np.cumsum(n)]
                held.append((wb.ints(batch.column(0))[lo:hi], wb.ints(batch.column(1))[lo:hi], n[lo:hi], flat[edge[lo] : edge[hi]]))
                size += int(edge[hi] - edge[lo])
                if size >= PACKED:
                    yield from out(held, pack)
                    held, size, pack = [], 0, pack + 1
        if size:
            yield from out(held, pack)
        held.clear()
        wb.release()

    return run


def _summed_keys(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of ``n`` of each."""
    out, place = np.unique(keys, return_inverse=True)
    return out, np.bincount(place, n, len(out)).astype(np.int64)


def _tally(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Keys in order and a number for each, packed."""
    return zstandard.ZstdCompressor(level=1).compress(_planes(np.diff(keys, prepend=np.int64(0))) + _planes(n))


def _read_tally(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    m = len(raw) // 16
    return np.cumsum(_from_planes(raw, np.int64, m, 0)), _from_planes(raw, np.int64, m, 8 * m)


def _read_group(table: pa.Table):
    """Tokens in order, with key, ident, pack and whether settled."""
    parts = []
    for kind, pack, blob in zip(table.column("kind").to_pylist(), table.column("pack").to_pylist(), table.column("blob"), strict=True):
        if kind == 0:
            token, text, keys, idents = _unpack(blob.as_py())
            parts.append((token, keys[text >> 1], idents[text >> 1], np.full(len(token), pack), text & 1))
    out = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4]
    order = np.lexsort((out[1], out[0]))
    return [x[order] for x in out]


def _shared(token, ident):
    """Rows whose token texts of two idents have."""
    start = _runs(token)
    if not len(start):
        return np.zeros(0, dtype=bool)
    many = np.minimum.reduceat(ident, start) < np.maximum.reduceat(ident, start)
    return np.repeat(many, np.diff(np.r_[start, len(token)]))


def _counted(table: pa.Table) -> pa.Table:
    """(pack, blob): the answer to each pack, of its texts how many tokens of this group they share."""
    token, key, ident, pack, known = _read_group(table)
    ok = _shared(token, ident) & (known == 0)
    key, pack = key[ok], pack[ok]
    order = np.argsort(pack, kind="stable")
    key, pack = key[order], pack[order]
    start = _runs(pack)
    stop = np.r_[start[1:], len(pack)][: len(start)]
    told = [(p, blob.as_py()) for kind, p, blob in zip(table.column("kind").to_pylist(), table.column("pack").to_pylist(), table.column("blob"), strict=True) if kind == 1]
    told += [(int(pack[a]), _tally(*np.unique(key[a:b], return_counts=True))) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
    return pa.table({"pack": pa.array([p for p, _ in told], pa.int64()), "blob": pa.array([b for _, b in told], pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    """(key, n): the answers to one pack, summed by text."""
    read = [_read_tally(b.as_py()) for b in table.column("blob")]
    keys, n = _summed_keys(*(np.concatenate(x) for x in zip(*read, strict=True)))
    return pa.table({"key": pa.array(keys), "n": pa.array(n)})


def _listed(table: pa.Table) -> pa.Table:
    """(key, token, n): the shared tokens of each text, and how many texts have each of them."""
    token, key, ident, _, _ = _read_group(table)
    once = np.ones(len(token), dtype=bool)
    once[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    token, key, ident = token[once], key[once], ident[once]
    size = np.diff(np.r_[_runs(token), len(token)])
    n, ok = np.repeat(size, size), _shared(token, ident)
    return pa.table({"key": pa.array(key[ok]), "token": pa.array(wb.signed(token[ok])), "n": pa.array(n[ok].astype(np.int64))})


def shared_tokens(rows: DataFrame, parts: int, shift: int = 0, count: bool = False) -> DataFrame:
    """What texts share with texts of another ident; ``rows`` has (key, ident, tokens).

    (key, token, n), n being the texts that have the token; with ``count`` only (key, n), the
    number of tokens shared, in one or more rows a key (a group answers each pack of texts that
    asked it, and the answers to a pack meet).  ``shift`` drops low bits, which can only make
    more tokens equal.
    """
    packed = rows.mapInArrow(_packer(max(8, GROUPS_PER_PARTITION * parts), shift, count), "grp int, kind byte, pack long, blob binary").groupBy("grp")
    if count:
        return packed.applyInArrow(_counted, "pack long, blob binary").groupBy("pack").applyInArrow(_added, "key long, n long")
    return packed.applyInArrow(_listed, "key long, token long, n long")


_MEETING = "token long, cell long, block long, rid long, component long, n long, at long, kept long, parity binary"


def _prefixes(batches):
    """Rows of _MEETING from (rid, component, n_shingles, tokens), the tokens in the common order."""
    for batch in batches:
        rid, component, size = (wb.ints(batch.column(i)) for i in range(3))
        for i, tokens in enumerate(batch.column(3)):
            many, token = (np.array(tokens.values.field(k)) for k in (0, 1))
            kept = len(token)
            first = kept - int(needed(size[i])) + 1
            bit = np.bincount((wb.mix(token.view(np.uint64) + _U64(0x7F4A7C15)) % _U64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
            parity = np.packbits(bit.astype(np.uint8)).tobytes()
            blocks = -(-many[:first] // BLOCK)
            own = int(wb.mix(np.array([rid[i]]).view(np.uint64))[0])
            block = np.array([own % int(b) for b in blocks], dtype=np.int64)
            at = np.repeat(np.arange(first), blocks)
            other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            mine = block[at]
            cell = np.minimum(mine, other) * blocks[at] + np.maximum(mine, other)
            cell = np.where(mine == other, cell, -1 - cell)
            same = lambda x, m=len(at): pa.array(np.full(m, x, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[at]), pa.array(cell), pa.array(mine), same(rid[i]), same(component[i]), same(size[i]), pa.array(at.astype(np.int64)), same(kept), pa.array([parity] * len(at), pa.binary())],
                names=[c.split()[0] for c in _MEETING.split(", ")],
            )


def _pairs_of(token, cell, block, rid, component, size, at, kept, parity) -> Iterator[np.ndarray]:
    """(a, b) of rids of different components that may share enough, from rows in order of (token, cell, size)."""
    i, d = np.arange(len(token)), 0
    while len(i):
        d += 1
        i = i[i + d < len(token)]
        j = i + d
        # Sizes grow within a cell: beyond the first that is too large all are.
        i = i[(token[i] == token[j]) & (cell[i] == cell[j]) & (100 * size[i] >= LEAST_PERCENT * size[j])]
        j = i + d
        need = (LEAST_PERCENT * (size[i] + size[j]) + 99 + LEAST_PERCENT) // (100 + LEAST_PERCENT)
        common = np.minimum(at[i], at[j]) + np.minimum(kept[i] - at[i], kept[j] - at[j])
        ok = (component[i] != component[j]) & (common >= need) & ((block[i] == block[j]) == (cell[i] >= 0))
        x, y, need = i[ok], j[ok], need[ok]
        for lo in range(0, len(x), _PAIRS):
            a, b = x[lo : lo + _PAIRS], y[lo : lo + _PAIRS]
            apart = np.bitwise_count(parity[a] ^ parity[b]).sum(axis=1, dtype=np.int64)
            ok = (kept[a] + kept[b] - apart) // 2 >= need[lo : lo + _PAIRS]
            a, b = rid[a[ok]], rid[b[ok]]
            if len(a):
                yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def _meetings(batches):
    """Different (a, b) that meet, from rows of _MEETING in order of token, cell and n."""

    def emit(parts):
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        made = list(_pairs_of(*columns))
        if made:
            pairs = np.unique(np.concatenate(made), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    waiting, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
        parity = batch.column(batch.num_columns - 1).cast(pa.binary(8 * PARITY))
        now.append(np.frombuffer(parity.buffers()[1], np.uint64).reshape(-1, PARITY)[parity.offset : parity.offset + len(parity)])
        # The last token may go on in the next batch.
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if waiting and waiting[-1][0][-1] != now[0][-1] and rows + cut > 1 << 17:
            yield from emit([*waiting, [c[:cut] for c in now]])
            waiting, rows, now = [], 0, [c[cut:] for c in now]
        waiting.append(now)
        rows += len(now[0])
    if waiting:
        yield from emit(waiting)


def _sets(batches):
    for batch in batches:
        data, offsets = wb.utf8(batch.column(1))
        for lo, hi in wb.groups(offsets):
            a, b = offsets[lo], offsets[hi]
            sets = shingle_sets(data[a:b], offsets[lo : hi + 1] - a)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rid", "hashes"])


def _keyed_sets(batches):
    """(rid, component, key, n_shingles, tokens) from (rid, text, component); equal sets of one rid have one key."""
    for batch in batches:
        data, offsets = wb.utf8(batch.column(1))
        for lo, hi in wb.groups(offsets):
            a, b = offsets[lo], offsets[hi]
            sets = shingle_sets(data[a:b], offsets[lo : hi + 1] - a)
            rid, n = batch.column(0).slice(lo, hi - lo), np.array([len(s) for s in sets], dtype=np.int64)
            key = wb.mix(fingerprints(sets)[0] + wb.mix(wb.ints(rid).view(np.uint64)))
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(wb.signed(np.concatenate(sets))))
            yield pa.RecordBatch.from_arrays([rid, batch.column(2).slice(lo, hi - lo), pa.array(wb.signed(key)), pa.array(n), tokens], names=["rid", "component", "key", "n_shingles", "tokens"])


_KEYED_SETS = "rid long, component long, key long, n_shingles long, tokens array<long>"


def _confirmed(batches, read=lambda x: np.frombuffer(x.as_buffer(), dtype=np.uint64)):
    """Keep the edges whose full sets are similar enough."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        ok = []
        for i in range(batch.num_rows):
            a, b = read(left[i]), read(right[i])
            if 100 * min(len(a), len(b)) < LEAST_PERCENT * max(len(a), len(b)):
                ok.append(False)
                continue
            both = np.concatenate([a, b])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            ok.append(100 * common >= LEAST_PERCENT * (len(a) + len(b) - common))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _confirmed_lists(batches):
    return _confirmed(batches, lambda x: x.values.to_numpy())


def stars(rows: DataFrame) -> DataFrame:
    """(bucket, a, near, rid): each member of a bucket with its least member, from (rid, bucket).

    ``near`` is a second centre: the member nearest to the bucket's key by exclusive or,
    so a text meets another one in each of its buckets.
    """
    near = F.min(F.col("rid").bitwiseXOR(F.col("bucket"))).bitwiseXOR(F.col("bucket"))
    centre = rows.groupBy("bucket").agg(F.min("rid").alias("a"), F.max("rid").alias("z"), near.alias("near")).where("a < z").drop("z")
    return rows.join(centre, "bucket").where("a < rid").select("bucket", "a", "near", "rid")


def _edges(memberships: DataFrame) -> DataFrame:
    return memberships.select("a", F.col("rid").alias("b")).distinct()


def unlike(memberships: DataFrame, links: DataFrame) -> DataFrame:
    """Members that their centre does not resemble."""
    return memberships.join(links.select("a", F.col("b").alias("rid")), ["a", "rid"], "left_anti")


def second_stars(failed: DataFrame) -> DataFrame:
    """(a, b): members that failed at their centre with the second centre of the same bucket.

    The second centre may be one that did resemble the first, which dealing the failed
    members among themselves would never reach.
    """
    return failed.where("near not in (rid, a)").select(F.col("near").alias("a"), F.col("rid").alias("b")).distinct()


def linked_stars(heads: DataFrame, failed: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): members that failed at their centre with the member of the same bucket that has most links.

    The text that joins a group resembles the centres of all its buckets, so it has many.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("rid")).groupBy("rid").agg(F.count("*").alias("n")).where("n > 1")
    joined = heads.select("rid", "bands").join(ends, "rid").select("rid", "n", F.explode("bands").alias("bucket"))
    centre = joined.join(failed.select("bucket").distinct(), "bucket", "left_semi").groupBy("bucket").agg(F.max(F.struct("n", "rid")).alias("top"))
    return failed.join(centre, "bucket").select(F.col("top.rid").alias("a"), F.col("rid").alias("b")).where("a <> b").distinct()


def unmet(signed: DataFrame, heads: DataFrame, labels: DataFrame, keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b): texts of different components that may share enough; and (rid, hashes), the sets of such texts.

    ``labels`` has (rid, component), ``keyed`` (rid, text).
    """
    spark, parts = keyed.sparkSession, keyed.rdd.getNumPartitions()
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    shift = max(0, 64 - 8 - int(total).bit_length())  # one token in 256 looks shared by chance
    firsts = signed.where("n_shingles > 0").select(F.col("rid").alias("key"), F.col("rid").alias("ident"), F.col("firsts").alias("tokens"))
    shares = shared_tokens(firsts, parts, shift, count=True).groupBy(F.col("key").alias("rid")).agg(F.sum("n").alias("n"))
    enough = F.expr(f"n >= 1 + floor(ceil({LEAST_PERCENT} * n_shingles / 100.0) / {MARGIN})")
    left = heads.select("rid", "n_shingles").join(shares, "rid").where(enough).select("rid").distinct()
    left = scratch.table(spark, left.join(labels, "rid", "left").select("rid", F.coalesce("component", "rid").alias("component")), "left")
    sets = scratch.table(spark, keyed.join(left, "rid").select("rid", "text", "component").mapInArrow(_keyed_sets, _KEYED_SETS), "left_sets")
    listed = shared_tokens(sets.select("key", F.col("component").alias("ident"), "tokens"), parts)
    kept = listed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    texts = sets.select("key", "rid", "component", "n_shingles").distinct()
    full = kept.join(texts, "key").where(F.expr(f"100L * size(tokens) >= {LEAST_PERCENT} * n_shingles"))
    dealt = full.select("rid", "component", "n_shingles", "tokens").mapInArrow(_prefixes, _MEETING).repartition("token", "cell")
    met = dealt.sortWithinPartitions("token", "cell", "n").mapInArrow(_meetings, "a long, b long").distinct()
    return met, sets


def shingle_table(spark: SparkSession, docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(rid, hashes): the full sets of all texts that stand in an edge; ``docs`` has (rid, text)."""
    wanted = edges.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    return scratch.table(spark, docs.join(wanted.hint("merge"), "rid").select("rid", "text").mapInArrow(_sets, "rid long, hashes binary"), "shingles")


def confirm(sets: DataFrame, edges: DataFrame, compare=_confirmed) -> DataFrame:
    """Edges that hold on the full shingle sets.

    All joins are sort-merge joins: the edges grow with the corpus, so they are never
    broadcast, however few they are, and hot keys can be split.
    """
    partners = edges.groupBy("a").agg(F.count("*").alias("n"))
    salts = partners.select("a", F.ceil(F.col("n") / PARTNERS_PER_TASK).alias("salts"))
    dealt = edges.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    centres = salts.select(F.col("a").alias("rid"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")).hint("merge").join(sets, "rid")
    paired = (
        dealt.hint("merge")
        .join(sets.select(F.col("rid").alias("b"), F.col("hashes").alias("right")), "b")
        .join(centres.select(F.col("rid").alias("a"), "salt", F.col("hashes").alias("left")).hint("merge"), ["a", "salt"])
        .select("a", "b", "left", "right")
    )
    return paired.mapInArrow(compare, "a long, b long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(rid, component): the least rid reachable, for every rid that has a link.

    ``links`` has (a, b) with a < b.  Each round gives every node the least label
    among its own and its partners', then follows labels once more; minima are
    combined map-side and rows are a few bytes wide.
    """
    both = scratch.table(spark, links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    state = scratch.table(spark, both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "rid"), "labels")
    while True:
        near = both.join(state.select(F.col("rid").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hop = state.select(F.col("rid").alias("label"), F.col("label").alias("beyond"))
        # A root takes the least label that any member of its tree sees, so trees merge whole.
        seen = state.join(near.withColumnRenamed("a", "rid"), "rid").select("rid", F.col("label").alias("old"), F.least("label", "near").alias("near"))
        hooked = seen.groupBy("old").agg(F.min("near").alias("root"))
        moved = (
            seen.join(hooked, "old")
            .select("rid", "old", F.least("near", "root").alias("label"))
            .join(hop, "label", "left")
            .select("rid", "old", F.least("label", F.coalesce("beyond", "label")).alias("label"))
        )
        after = scratch.table(spark, moved, "labels")
        changed = after.where("label <> old").limit(1).count()
        state = after.select("rid", "label")
        if not changed:
            return state.withColumnRenamed("label", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("rid"), "text")
    signed = scratch.table(spark, keyed.mapInArrow(_signed_rows, "rid long, n_shingles long, fp1 long, fp2 long, bands array<long>, firsts array<long>"), "signatures")
    prints = ["n_shingles", "fp1", "fp2"]
    with_set = signed.where("n_shingles > 0")
    classes = scratch.table(spark, with_set.groupBy(*prints).agg(F.min("rid").alias("head"), F.max("rid").alias("tail")), "classes")
    # Members point at the head of their set; classes of one row need no link.
    copies = with_set.select("rid", *prints).join(classes.where("head < tail"), prints).where("rid > head").select(F.col("head").alias("a"), F.col("rid").alias("b")).distinct()
    heads = with_set.join(classes.select(F.col("head").alias("rid"), *prints), ["rid", *prints], "left_semi")
    met = scratch.table(spark, stars(heads.select("rid", F.explode("bands").alias("bucket"))), "stars")
    tried = scratch.table(spark, _edges(met), "edges")
    sets = shingle_table(spark, keyed, tried)
    found = scratch.table(spark, confirm(sets, tried).distinct(), "links")
    failed = scratch.table(spark, unlike(met, found), "failed")
    again = second_stars(failed).unionAll(linked_stars(heads, failed, found)).distinct().join(tried, ["a", "b"], "left_anti")
    more = confirm(sets, scratch.table(spark, again, "edges")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # A doc_id on several rows may have several sets; its heads are then one node.
    several = signed.groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select(F.col("rid").alias("b"))
    links = found.unionAll(more).unionAll(copies.join(several, "b", "left_semi").select("a", "b")).distinct()
    links = scratch.table(spark, links, "confirmed")
    near = components(spark, links)
    rest, kept = unmet(signed, heads, near, keyed)
    rest = scratch.table(spark, rest, "rest")
    late = scratch.table(spark, confirm(kept.select("rid", F.col("tokens").alias("hashes")), rest, _confirmed_lists).distinct(), "links")
    if late.limit(1).count():
        near = components(spark, links.unionAll(late))
    return _labelled(signed, copies, near)


def _labelled(signed: DataFrame, copies: DataFrame, near: DataFrame) -> DataFrame:
    """Components of all rows: of copies that of their head, of others their own doc_id."""
    nearest = copies.groupBy("b").agg(F.min("a").alias("head")).withColumnRenamed("b", "rid")
    out = (
        signed.select("rid", "n_shingles")
        .join(nearest, "rid", "left")
        .withColumn("head", F.coalesce("head", "rid"))
        .join(near.withColumnRenamed("rid", "head"), "head", "left")
        .withColumn("component", F.coalesce("component", "head"))
    )
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return out.select(real("rid").alias("doc_id"), "n_shingles", real("component").alias("component_id"), (F.col("rid") == F.col("component")).alias("kept"))



def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without all but the least doc_id of each class."""
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    return docs.alias("d").join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id"), "left_semi")
