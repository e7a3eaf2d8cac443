"""Words and word hashes of whole Arrow batches, computed on the UTF-8 bytes with numpy.

Splitting and hashing look at bytes only, so no Python string is made per word.
Work goes in pieces of about half a megabyte, so memory stays flat however long
a text is; only word-level arrays (16 bytes a word) are kept for a group of texts.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
GROUP = 2 << 20
U64 = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240229))
_GRAM = _rng.integers(1 << 62, (1 << 64) - 1, 64, dtype=np.uint64, endpoint=True) | U64(1)
#: A-Z become a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: The low n bytes of an integer, n from 0 to 8.
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def release() -> None:
    """Give memory that is free again back to the system; a worker may wait long for its next task."""
    with contextlib.suppress(OSError, AttributeError):  # there only with glibc
        ctypes.CDLL(None).malloc_trim(0)


def byte_class(test) -> np.ndarray:
    """A table of 256 booleans."""
    return np.array([bool(test(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, letters, all beyond ASCII
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def groups(offsets: np.ndarray, limit: int = GROUP) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes; a longer text stands alone."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word's index of each text (n + 1 values)."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of the words; ``fold`` makes A-Z equal to a-z.

    A word is read as integers of eight bytes.  One of up to seven bytes is its integer
    with the length above, put through a bijection, so such words never collide.  Of a
    longer one, each integer goes through the bijection together with its place, and
    these are summed; so no pattern of letters cancels out, as it does in a polynomial
    modulo a power of two.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        part = np.zeros(b - a + 8, dtype=np.uint8)
        part[: b - a] = FOLD[data[a:b]] if fold else data[a:b]
        eight = np.ndarray((b - a + 1,), "<u8", part, 0, (1,))
        s, n = starts[lo:hi] - a, ends[lo:hi] - starts[lo:hi]
        value = (eight[s] & _LOW[np.minimum(n, 8)]) + (np.minimum(n, 255).astype(np.uint64) << U64(56)) * (n < 8)
        value = mix(value)
        more = np.flatnonzero(n >= 8)
        if len(more):
            parts = n[more] // 8  # integers after the first, the last of them maybe short or empty
            owner = np.repeat(more, parts)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts) + 1
            at = np.minimum(s[owner] + 8 * place, b - a)
            rest = eight[at] & _LOW[np.clip(n[owner] - 8 * place, 0, 8)]
            mixed = mix(mix(rest + U64(0x2545F4914F6CDD1D)) ^ mix(place.astype(np.uint64) + U64(0x5851F42D4C957F2D)))
            sums = np.add.reduceat(mixed, np.cumsum(parts) - parts)
            value[more] = mix(value[more] + sums * U64(0x9E3779B97F4A7C15) + n[more].astype(np.uint64) * U64(0xA0761D6478BD642F))
        out[lo:hi] = value
        lo = hi
    return out


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes, across text borders too."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(words) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        out += words[j : j + m] * _GRAM[j % 64]
    return mix(out + U64(n))


def sequence_hash(words: np.ndarray) -> int:
    """One hash of a whole word sequence."""
    total = np.sum(mix(words + np.arange(1, len(words) + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)), dtype=np.uint64)
    return int(mix(np.array([total + U64(len(words))], dtype=np.uint64))[0])


def signed(a: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return a.view(np.int64)


def ints(column) -> np.ndarray:
    """An integer column as int64; nulls become 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
