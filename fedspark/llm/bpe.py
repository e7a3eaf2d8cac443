"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (token bytes, rank) is turned into the library's vocabulary and merges:
every byte has one printable character (the usual byte table), and the merge that
makes a token is found by applying all merges of a lower rank to its bytes.  The
tokenizer is broadcast as text, so executors need no file.

A text is cut into its pre-tokens (the matches of the pattern) once.  A pre-token is
encoded by the library when a worker first meets it; its ids and the characters that
each of them touches are then held in flat arrays, and texts gather from these.  What
is held is bounded by bytes: beyond ``HELD_BYTES`` the worker starts afresh.  Where
the pattern's character classes may be read differently by the library and by the
splitter (code points of newer Unicode versions; each is tried once), the library
cuts the text.  At the end of a partition the worker drops the tokenizer and what it
holds, as other operators may use the worker next.

Decoding looks the ids' bytes up; a character that two tokens share is put together
again, because bytes are joined before they are read as UTF-8 (and held back at the
end of a piece when decoding runs piece by piece).

Defined cases: a null text counts as empty (no ids, the hash of nothing); an empty
table gives an empty result; a null doc_id passes through; rows are encoded one by
one, so repeated rows give equal results; texts of any length are encoded whole, with
memory that follows the longest text of a batch; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb

#: Bytes of text handed to the library at once.
BATCH_BYTES = 1 << 20
#: Bytes of pre-tokens, ids and offsets that a worker holds.
HELD_BYTES = 48 << 20
_built: dict[str, object] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two tokens whose merge makes ``token``."""
    limit, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if rank >= limit:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def build(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer, as the library's JSON."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    shown = lambda token: "".join(chars[b] for b in token)
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            parts = _parts(token, ranks)
            if len(parts) == 2:
                merges.append((shown(parts[0]), shown(parts[1])))
    made = Tokenizer(models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made.to_str()


def _put(held: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``new`` written at ``at``, in a larger array if need be."""
    if len(held) < at + len(new):
        held = np.concatenate([held, np.zeros(at + len(new), held.dtype)])
    held[at : at + len(new)] = new
    return held


class _Places(dict):
    """The place of each pre-token; one that was not met before gets the next and stands in ``fresh``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place


class Codec:
    """Encoder and decoder of one vocabulary; built once a worker."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = True
        # Texts are cut before the tokenizer gets them.
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        self.size_of = np.array(list(map(len, self.bytes_of)), dtype=np.int64)
        pattern = json.loads(text)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern).findall
        self.library_split = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str
        self.known: set[str] = set(map(chr, range(128)))
        self.odd: set[str] = set()
        self._forget()

    @staticmethod
    def of(text: str) -> Codec:
        key = hashlib.sha256(text.encode()).hexdigest()
        if key not in _built:
            _built.clear()
            _built[key] = Codec(text)
        return _built[key]

    def _forget(self) -> None:
        self.place = _Places()
        self.held = self.used = 0
        #: Of all pre-tokens met: number of ids, first id's place, length; ids, starts and ends.
        self.sizes, self.flat = [np.zeros(0, np.int64)] * 3, [np.zeros(0, np.int32)] * 3

    def _try_characters(self, texts: list[str]) -> None:
        """Which characters of ``texts`` are of another class to the library than to the splitter."""
        from tokenizers import Regex, pre_tokenizers

        for c in set().union(*map(set, texts)) - self.known:
            self.known.add(c)
            for kind in (r"\p{L}", r"\p{N}", r"\s"):
                if bool(regex.match(kind, c)) == bool(pre_tokenizers.Split(Regex(kind), "removed").pre_tokenize_str(c)):
                    self.odd.add(c)

    def _add(self, words: list[str]) -> None:
        """Hold the ids of each of ``words``, which the library gets as they are cut, and their offsets:
        the bytes of the ids follow each other in the word, and each byte is of one character."""
        for lo in range(0, len(words), 1 << 12):
            part = words[lo : lo + (1 << 12)]
            (made,) = self.tokenizer.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(made.ids, dtype=np.int32)
            written = [w.encode() for w in part]
            raw = np.frombuffer(b"".join(written), dtype=np.uint8)
            size, ends = self.size_of[ids], np.cumsum(self.size_of[ids])
            if ends[-1] != len(raw):
                raise ValueError("the vocabulary lacks a byte")
            n = np.diff(np.searchsorted(ends, np.cumsum(np.fromiter(map(len, written), np.int64, len(part))), "right"), prepend=0)
            length = np.fromiter(map(len, part), np.int64, len(part))
            character, before = np.cumsum((raw & 0xC0) != 0x80), np.repeat(np.cumsum(length) - length, n)
            flat = [ids, (character[ends - size] - 1 - before).astype(np.int32), (character[ends - 1] - before).astype(np.int32)]
            self.sizes = [_put(x, len(self.place) - len(words) + lo, y) for x, y in zip(self.sizes, (n, np.cumsum(n) - n + self.used, length), strict=True)]
            self.flat = [_put(x, self.used, y) for x, y in zip(self.flat, flat, strict=True)]
            self.used += len(ids)

    def _gather(self, texts: list[list[str]]):
        """Sizes of the texts and their flat arrays, from their pre-tokens."""
        if self.held > HELD_BYTES:
            self._forget()
        first = np.cumsum([0, *map(len, texts)])
        index = np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), np.int64, first[-1])
        fresh, self.place.fresh = self.place.fresh, []
        self.held += sum(4 * len(w) + 200 for w in fresh)
        self._add(fresh)
        n, at, length = (x[index] for x in self.sizes)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - at, n)
        before = np.cumsum(length) - length
        ends = np.concatenate([before, [length.sum()]])[first]
        shift = np.repeat(before - np.repeat(ends[:-1], np.diff(first)), n).astype(np.int32)
        ids, starts, stops = (x[inner] for x in self.flat)
        tokens = np.concatenate([[0], np.cumsum(n)])[first]
        return np.diff(tokens), ids, starts + shift, stops + shift

    def encode(self, texts: list[str]) -> list[list[int]]:
        n, ids, _, _ = self.encode_flat(texts)
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids of each text; all ids, and the first and last character (exclusive) that
        each of them touches.  Tokens that share a character name it both."""
        self._try_characters(texts)
        odd = [bool(self.odd) and not self.odd.isdisjoint(t) for t in texts]
        return self._gather([[w for w, _ in self.library_split(t)] if o else self.split(t) for t, o in zip(texts, odd, strict=True)])

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_stream(self, pieces: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of each piece; a character split between pieces comes out with the later one."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in pieces:
            yield reader.decode(self.decode_bytes(ids))
        rest = reader.decode(b"", final=True)
        if rest:
            yield rest


def _encoded(batches, tokenizer: str) -> Iterator[tuple]:
    """(doc_ids, number of ids of each row, ids, starts, ends) of about BATCH_BYTES of text at a time."""
    codec = Codec.of(tokenizer)
    for batch in batches:
        _, offsets = wb.utf8(batch.column(1))
        for lo, hi in wb.groups(offsets, BATCH_BYTES):
            texts = [t if t is not None else "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
            yield batch.column(0).slice(lo, hi - lo), *codec.encode_flat(texts)
    _built.clear()
    del codec
    wb.release()


def _lists(n: np.ndarray, *flat: np.ndarray) -> list[pa.Array]:
    edges = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
    return [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in flat]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, starts, ends: token ids and the character range of each, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        for doc_id, n, *flat in _encoded(batches, shared.value):
            yield pa.RecordBatch.from_arrays([doc_id, *_lists(n, *flat)], names=["doc_id", "ids", "starts", "ends"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text from doc_id and ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        codec = Codec.of(shared.value)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_split of every row: texts are encoded with
    offsets, and their ids decoded again.  ``n_split`` counts tokens that begin inside a character."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split"]

    def run(batches):
        codec = Codec.of(shared.value)
        for doc_id, n, ids, starts, ends in _encoded(batches, shared.value):
            edges = np.concatenate([[0], np.cumsum(n)])
            inside = np.zeros(len(ids) + 1, dtype=np.int64)
            inside[2:] = starts[1:] < ends[:-1]  # a character that the token before touches too
            inside[edges[:-1][n > 0] + 1] = 0
            split = np.cumsum(inside)
            raw, edge = ids.astype("<u4"), edges.tolist()
            sums = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(edge[:-1], edge[1:], strict=True)]
            listed = ids.tolist()
            back = [hashlib.sha256(codec.decode_bytes(listed[a:b])).hexdigest() for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string()), pa.array(split[edges[1:]] - split[edges[:-1]])], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long")
