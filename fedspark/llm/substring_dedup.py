"""Substring deduplication with prefix-partitioned suffix trees.

Every document is a sequence of words.  A window is ``WINDOW`` (20) consecutive
words, that is, a suffix cut at depth 20.  A word goes if a window over it has a
word sequence that also starts earlier (a smaller doc_id, or the same document
further left).

* Suffixes are dealt into groups by a prefix that the text itself picks.  Of the
  13 eight-word prefixes that a window holds, the one with the least hash is its
  anchor.  Equal windows have equal anchors at equal distances, and neighbouring
  suffixes share one, so one record carries about seven suffixes.
* A task combines what it reads: of equal windows only the earliest travels, so a
  passage that stands in a third of all documents reaches its group once per
  map group, not once per document.
* Prefixes have variable length: a first pass counts the eight-word prefixes that
  go on in many ways; where the whole corpus has more than ``MEMORY_SUFFIXES``
  below one, it is lengthened to the whole window in every task, so its suffixes
  are dealt over all groups.
* The number of groups follows the number of input partitions, so a group holds
  about a quarter of what a map task reads.  Its subtree is built in memory:
  leaves are sorted below their prefix, and each inner node at depth 20 with more
  than one leaf is a repeat.  All but its first leaf are marked, and runs of
  marked suffixes are the maximal repeats.

Labels of the nodes are hashes in place of words, which keeps what travels small: a
node is the hash of its prefix (64 bits), the place in it and a hash of its window (32
bits), all three compared, so word sequences that differ count as equal with a chance of
about 2**-90 a pair.  Repeats that are settled on the map side are compared word by word.

Defined cases: a null text has no words; fewer than 20 words have no window; an empty
table gives an empty result; a null doc_id counts as the smallest; rows that share a
doc_id are each judged against all, and windows at the same place of such rows do not
precede each other; rows equal in doc_id and text all get the same result; texts of any length are read whole, in arrays of 60 bytes a word; other columns of
the input are ignored by ``remove_repeats`` and kept by ``clean``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb

WINDOW = 20
PREFIX = 8
#: Text bytes whose windows are combined before they travel.
COMBINE_BYTES = 4 << 20
#: Different suffixes of one prefix in a map group from which it is counted as a candidate.
HEAVY = 32
#: Suffixes below one prefix, in the whole corpus, beyond which it is lengthened.
MEMORY_SUFFIXES = 200_000
#: Lengthened prefixes at most (8 bytes each in every task); any choice gives the same repeats.
MAX_LONG = 1_000_000
GROUPS_PER_PARTITION = 4

_NO_ID = -(1 << 63)
_U64, _U32 = np.uint64, np.uint32
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def _windows(data, offsets):
    """Anchor, distance to it, label, row, start word and place of all windows, in the order of the text;
    and the ids of all words: equal words, and only they, have equal ids."""
    starts, ends, first = wb.spans(data, offsets, wb.NOT_SPACE)
    hashes = wb.hashes(data, starts, ends)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return None
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    if not len(keep):
        return None
    prefixes = wb.grams(hashes, PREFIX)
    at = np.empty(n, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(prefixes, WINDOW - PREFIX + 1)
    for lo in range(0, n, 1 << 16):
        at[lo : lo + (1 << 16)] = view[lo : min(n, lo + (1 << 16))].argmin(axis=1)
    own = owner[keep]
    return {
        "anchor": prefixes[keep + at[keep]],
        "away": at[keep].astype(np.uint8),
        "label": (wb.grams(hashes, WINDOW)[keep] >> _U64(32)).astype(_U32),
        "row": own.astype(np.int32),
        "start": (keep - first[own]).astype(np.int32),
        "place": keep.astype(np.int32),
    }, (data, starts, ends)


def _same_words(words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j are equal, pair by pair, byte by byte."""
    data, starts, ends = words
    size = ends[i] - starts[i]
    same = size == ends[j] - starts[j]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    open_ = np.flatnonzero(same)
    step = 0
    while len(open_):
        left = size[open_] - step
        mask = _LOW_BYTES[np.minimum(left, 8)]
        differ = (eight[starts[i[open_]] + step] ^ eight[starts[j[open_]] + step]) & mask != 0
        same[open_[differ]] = False
        step += 8
        open_ = open_[~differ & (left > 8)]
    return same


def _key(anchor, away, label):
    return wb.mix(anchor ^ wb.mix((label.astype(_U64) << _U64(8)) | away.astype(_U64)))


def _pack(part: dict) -> bytes:
    """Columns one after another, compressed; ``doc`` and ``fp`` as differences."""
    n = np.array([len(part["anchor"]), len(part["label"])], dtype=np.int64)
    diff = lambda a: np.diff(a, prepend=a.dtype.type(0))
    raw = b"".join(
        x.tobytes()
        for x in (n, part["anchor"], diff(part["doc"]), diff(part["fp"]), part["start"], part["away"], part["count"], part["label"])
    )
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes) -> dict:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2)
    out, at = {}, 16
    for name, kind, size in (("anchor", _U64, n), ("doc", np.int64, n), ("fp", np.int64, n), ("start", np.int32, n), ("away", np.uint8, n), ("count", np.uint8, n), ("label", _U32, m)):
        out[name] = np.frombuffer(raw, kind, size, at)
        at += out[name].nbytes
    for name in ("doc", "fp"):
        out[name] = np.cumsum(out[name])
    return out


def _earliest(w: dict, docs: np.ndarray, words=None) -> np.ndarray:
    """True where no equal window of this map group starts earlier; by doc_id, then start.

    With ``words`` windows are held against the earliest one word by word.
    """
    key = _key(w["anchor"], w["away"], w["label"])
    doc = docs[w["row"]]
    if np.all(np.diff(docs) > 0):
        order = np.argsort(key, kind="stable")
    else:
        before = np.lexsort((w["row"], w["start"], doc))
        order = before[np.argsort(key[before], kind="stable")]
    key = key[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = key[1:] != key[:-1]
    lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    out = np.empty(len(order), dtype=bool)
    out[order] = (doc[order] == doc[lead]) & (w["start"][order] == w["start"][lead])
    if words is not None:
        later = np.flatnonzero(~out[order])
        i, j = order[later], lead[later]
        for k in range(WINDOW):
            out[i] |= ~_same_words(words, w["place"][i] + k, w["place"][j] + k)
    return out


def _map_groups(batches):
    """Windows of about COMBINE_BYTES of text at a time, with the rows' doc_ids and fingerprints and the words."""

    def out(parts, docs, fps):
        data, docs, fps = np.concatenate([p[0] for p in parts]), np.concatenate(docs), np.concatenate(fps)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
        made = _windows(data, offsets)
        if made is not None:
            yield made[0], docs, fps, made[1]

    parts, docs, fps, held = [], [], [], 0
    for batch in batches:
        data, offsets = wb.utf8(batch.column(2))
        ids, prints = wb.ints(batch.column(0)), wb.ints(batch.column(1))
        for lo, hi in wb.groups(offsets, COMBINE_BYTES):
            a, b = offsets[lo], offsets[hi]
            parts.append((data[a:b], np.diff(offsets[lo : hi + 1])))
            docs.append(ids[lo:hi])
            fps.append(prints[lo:hi])
            held += int(b - a)
            if held >= COMBINE_BYTES:
                yield from out(parts, docs, fps)
                parts, docs, fps, held = [], [], [], 0
    if parts:
        yield from out(parts, docs, fps)


def _crowded(batches):
    """Prefixes with more than HEAVY different suffixes in a map group, with that number."""
    for w, docs, _, _ in _map_groups(batches):
        anchor, count = np.unique(w["anchor"][_earliest(w, docs)], return_counts=True)
        at = count > HEAVY
        if at.any():
            yield pa.RecordBatch.from_arrays([pa.array(wb.signed(anchor[at])), pa.array(count[at].astype(np.int64))], names=["anchor", "n"])
    wb.release()


def _mapped(n_groups: int, long_prefixes):
    """Map side: texts to packed suffix groups.  Rows of kind 1 carry spans settled here."""

    def deal(w, docs, fps, windows, records, count, target):
        group = (target % _U64(n_groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(n_groups + 1))
        begin = np.r_[0, np.cumsum(count.astype(np.int64))]
        for g in np.flatnonzero(np.diff(edges)).tolist():
            r = order[edges[g] : edges[g + 1]]
            c = count[r].astype(np.int64)
            inner = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[r], c)
            at = records[r]
            row = w["row"][at]
            yield g, 0, _pack({"anchor": w["anchor"][at], "doc": docs[row], "fp": fps[row], "start": w["start"][at], "away": w["away"][at], "count": count[r], "label": w["label"][windows[inner]]})

    def flush(w, docs, fps, words):
        earliest = _earliest(w, docs, words)
        known = np.flatnonzero(~earliest)
        if len(known):
            row, start = w["row"][known], w["start"][known]
            cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(start) != 1))
            lo, hi = np.r_[0, cut + 1], np.r_[cut, len(known) - 1]
            cols = np.stack([docs[row[lo]], fps[row[lo]], start[lo].astype(np.int64), (hi - lo + 1).astype(np.int64)])
            for a in range(0, cols.shape[1], 1 << 14):
                yield int(docs[row[lo[a]]]) % n_groups, 1, np.ascontiguousarray(cols[:, a : a + (1 << 14)]).tobytes()
        left = np.flatnonzero(earliest)
        anchor, row, start = (w[k][left] for k in ("anchor", "row", "start"))
        place = start.astype(np.int64) + w["away"][left]
        new = np.ones(len(left), dtype=bool)  # windows in a row with one anchor make one record
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        crowd = np.isin(anchor, long_prefixes.value) if len(long_prefixes.value) else np.zeros(len(left), dtype=bool)
        new |= crowd
        at = np.flatnonzero(new)
        count = np.diff(np.r_[at, len(left)]).astype(np.uint8)
        target = wb.mix(anchor[at] + _U64(0x51ED2701))
        if crowd.any():
            one = left[at[crowd[at]]]
            target[crowd[at]] = wb.mix(_key(w["anchor"][one], w["away"][one], w["label"][one]) + _U64(0x2545F491))
        yield from deal(w, docs, fps, left, left[at], count, target)

    def run(batches):
        for group in _map_groups(batches):
            rows = list(flush(*group))
            for lo in range(0, len(rows), 64):
                g, k, b = zip(*rows[lo : lo + 64])
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(k, pa.int8()), pa.array(b, pa.binary())], names=["grp", "kind", "blob"])
        wb.release()

    return run


def _subtree(table: pa.Table) -> pa.Table:
    """Build one group's subtree and return its repeats as (doc, fp, start, length)."""
    kinds = table.column("kind").to_numpy()
    blobs = table.column("blob")
    out = []
    records = []
    for i, kind in enumerate(kinds):
        blob = blobs[i].as_py()
        if kind == 1:
            x = np.frombuffer(blob, np.int64)
            out.append(tuple(x.reshape(4, -1)))
        else:
            records.append(_unpack(blob))
    if records:
        count = np.concatenate([r["count"] for r in records]).astype(np.int64)
        r = {k: np.concatenate([x[k] for x in records]) for k in ("anchor", "doc", "fp", "start", "away")}
        label = np.concatenate([x["label"] for x in records])
        order = np.argsort(r["anchor"], kind="stable")
        a = r["anchor"][order]
        same = np.zeros(len(a) + 1, dtype=bool)
        same[1:-1] = a[1:] == a[:-1]
        inner = np.zeros(len(a), dtype=bool)
        inner[order] = same[:-1] | same[1:]  # prefixes below which the tree has more than one leaf
        pick = np.repeat(inner, count)
        owner = np.repeat(np.arange(len(count)), count)[pick]
        step = (np.arange(len(label)) - np.repeat(np.cumsum(count) - count, count))[pick]
        start = r["start"][owner].astype(np.int64) + step
        away = (r["away"][owner].astype(np.int64) - step).astype(np.uint8)
        doc, fp = r["doc"][owner], r["fp"][owner]
        # Leaves below their prefix, place in it and window.
        node = [r["anchor"][owner], away, label[pick]]
        leaf = np.lexsort((start, fp, doc, *node[::-1]))
        head = np.ones(len(leaf), dtype=bool)
        head[1:] = np.any([x[leaf][1:] != x[leaf][:-1] for x in node], axis=0)
        lead = leaf[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(leaf) else leaf
        repeat = leaf[(doc[leaf] != doc[lead]) | (start[leaf] != start[lead])]
        if len(repeat):
            repeat = repeat[np.lexsort((start[repeat], fp[repeat], doc[repeat]))]
            d, f, s = doc[repeat], fp[repeat], start[repeat]
            new = np.ones(len(s), dtype=bool)
            new[1:] = (d[1:] != d[:-1]) | (f[1:] != f[:-1]) | (s[1:] > s[:-1] + 1)
            at = np.flatnonzero(new)
            last = np.r_[at[1:] - 1, len(s) - 1]
            out.append((d[at], f[at], s[at], s[last] - s[at] + 1))
    cols = [np.concatenate([x[i] for x in out]) for i in range(4)] if out else [np.zeros(0, np.int64)] * 4
    return pa.table({"rid": pa.array(cols[0], pa.int64()), "fp": pa.array(cols[1], pa.int64()), "start": pa.array(cols[2].astype(np.int32)), "length": pa.array(cols[3].astype(np.int32))})


def _applied(digest: bool):
    """Remove the words under the spans of each text."""

    def run(batches):
        for batch in batches:
            data, offsets = wb.utf8(batch.column(1))
            spans = batch.column(2)
            texts, words, removed = [], [], []
            for i in range(batch.num_rows):
                out, n = _words_left(data[offsets[i] : offsets[i + 1]], spans[i].as_py())
                words.append(n)
                removed.append(words[-1] - len(out))
                text = b" ".join(out)
                texts.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept_text"])

    return run


def _words_left(raw: np.ndarray, spans: list[dict] | None) -> tuple[list[bytes], int]:
    """Words that no repeat covers, and the number of all words."""
    blob = raw.tobytes()
    if not spans:
        out = blob.split()  # bytes know the same six separators as the word pattern
        return out, len(out)
    starts, ends, _ = wb.spans(raw, np.array([0, len(raw)]), wb.NOT_SPACE)
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    for s in spans:
        cover[s["start"]] += 1
        cover[s["start"] + s["length"] + WINDOW - 1] -= 1
    kept = np.cumsum(cover[:-1]) == 0
    return [blob[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist(), strict=True)], len(starts)


def _rewritten(batches):
    """Texts without their repeats; rows of which nothing is left go."""
    for batch in batches:
        texts, spans = batch.column(batch.schema.get_field_index("text")), batch.column(batch.num_columns - 1)
        data, offsets = wb.utf8(texts)
        new, keep = texts.to_pylist(), np.ones(batch.num_rows, dtype=bool)
        for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
            left, _ = _words_left(data[offsets[i] : offsets[i + 1]], spans[i].as_py())
            new[i], keep[i] = b" ".join(left).decode("utf-8"), bool(left)
        columns = [pa.array(new, pa.string()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep)).drop_columns([batch.schema.names[-1]])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("rid"), F.xxhash64("text").alias("fp"), "text")


def repeat_spans(docs: DataFrame) -> DataFrame:
    """(rid, fp, start, length): runs of ``length`` windows from word ``start`` that also stand earlier."""
    spark, keyed = docs.sparkSession, _keyed(docs)
    crowded = keyed.mapInArrow(_crowded, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # Any set of lengthened prefixes gives the same repeats; this one is at most MAX_LONG of the heaviest.
    heaviest = crowded.where(F.col("n") > MEMORY_SUFFIXES).orderBy(F.desc("n"), "anchor").limit(MAX_LONG).toArrow()
    long_prefixes = spark.sparkContext.broadcast(heaviest.column("anchor").to_numpy().view(np.uint64))
    n_groups = max(8, GROUPS_PER_PARTITION * docs.rdd.getNumPartitions())
    packed = keyed.mapInArrow(_mapped(n_groups, long_prefixes), "grp int, kind byte, blob binary")
    return packed.groupBy("grp").applyInArrow(_subtree, "rid long, fp long, start int, length int")


def _by_text(spans: DataFrame) -> DataFrame:
    """(rid, fp, spans): a text that stands on several rows has its spans once."""
    return spans.distinct().groupBy("rid", "fp").agg(F.collect_list(F.struct("start", "length")).alias("spans"))


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every row; with ``digest`` kept_sha256 in its place.

    ``docs`` needs doc_id and text; kept words are joined by one space.  Each text
    travels once, to meet its spans.
    """
    spans = _by_text(repeat_spans(docs))
    joined = (
        _keyed(docs)
        .join(spans, ["rid", "fp"], "left")
        .select(F.when(F.col("rid") != _NO_ID, F.col("rid")).alias("doc_id"), "text", "spans")
    )
    return joined.mapInArrow(_applied(digest), f"doc_id long, n_words long, n_removed long, {'kept_sha256' if digest else 'kept_text'} string")


def clean(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without repeats: a text that has some becomes its kept words joined
    by spaces (with n_chars to match), a text that is all repeats goes, others stay as they are."""
    name = "spans"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    spans = _by_text(repeat_spans(docs)).withColumnRenamed("spans", name)
    same = F.expr(f"coalesce(cast(d.doc_id as bigint), {_NO_ID}L) = s.rid and xxhash64(d.text) = s.fp".replace(f"{_NO_ID}L", "bigint('-9223372036854775808')"))
    joined = docs.alias("d").join(spans.alias("s"), same, "left").select("d.*", f"s.{name}")
    out = joined.mapInArrow(_rewritten, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
