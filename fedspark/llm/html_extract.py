"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, with the path
of open elements.  Each block becomes a vector of its hashed tag path (element names
and the parts of class and id), its hashed words and a few measures; a bidirectional
LSTM in numpy reads the whole sequence of a page and classifies every block with
that context.  Blocks labelled as article text are joined.

The labeller is trained here, on pages of a generator (``html_pages``) whose labels
are known; it learns neither from the pages it reads nor from their addresses.

Defined cases: a null html counts as empty and gives an empty text; pages without a
visible block give an empty text; unclosed elements, stray end tags and unfinished
comments are read as browsers do; null page_id and url pass through; rows are judged
one by one; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lstm
from . import wordbytes as wb

PATH_SLOTS, WORD_SLOTS, MEASURES = 256, 64, 8
#: Bytes of html that are read at once.
GROUP_BYTES = 1 << 20

#: Elements of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is no text of the page.
HIDDEN = frozenset("script style template noscript iframe textarea title svg math object audio video canvas".split())
#: What a start tag closes first: itself, up to the container that holds its kind.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_marks: dict[tuple[str, str], tuple[int, ...]] = {}


class Block:
    __slots__ = ("path", "tag", "parts", "linked", "text")

    def __init__(self, path, tag):
        self.path, self.tag, self.parts, self.linked, self.text = path, tag, [], 0, ""


def _slots(name: str, attributes: str) -> tuple[int, ...]:
    """Hashed slots of one element."""
    key = (name, attributes)
    got = _marks.get(key)
    if got is None:
        words = {"<" + name}
        for m in _NAMED.finditer(attributes):
            for w in _PARTS.findall(next(filter(None, m.groups()), "").lower()):
                words.add(w)
        got = tuple(sorted({crc32(w.encode()) % PATH_SLOTS for w in words}))
        if len(attributes) < 200:  # long ones seldom come again
            if len(_marks) > 50_000:
                _marks.clear()
            _marks[key] = got
    return got


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page in order, their white space joined and their references decoded."""
    stack: list[tuple[str, tuple[int, ...]]] = []
    out: list[Block] = []
    now: list[Block | None] = [None]
    links = 0

    def finish():
        b = now[0]
        if b is not None:
            b.text = " ".join(entities.unescape("".join(b.parts)).split())
            if b.text:
                out.append(b)
            now[0] = None

    def add(raw: str):
        if now[0] is None:
            if not raw.strip():
                return
            tag = next((n for n, _ in reversed(stack) if n in BLOCKS), "")
            now[0] = Block({s for _, slots in stack for s in slots}, tag)
        now[0].parts.append(raw)
        if links:
            now[0].linked += len(raw)

    def close_to(depth: int):
        nonlocal links
        for n, _ in stack[depth:]:
            links -= n == "a"
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            if name in BLOCKS:
                finish()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close_to(i)
                    break
                if name not in BLOCKS and stack[i][0] in BLOCKS:
                    break
            continue
        attributes = m[3] or m[6] or ""
        if name in HIDDEN:
            if not attributes.rstrip().endswith("/"):
                at = re.compile(rf"</{re.escape(name)}(?![\w-])[^>]*>|\Z", re.I).search(page, at).end()
            continue
        if name == "br":
            if now[0] is not None:
                now[0].parts.append(" ")
            continue
        if name in BLOCKS:
            finish()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close_to(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
            if name in CLOSES:
                which, within = CLOSES[name]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in within:
                        break
                    if stack[i][0] in which:
                        close_to(i)
                        break
        if name in VOID:
            continue
        stack.append((name, _slots(name, attributes)))
        links += name == "a"
    finish()
    return out


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """(blocks of all pages, features) in order."""
    flat = [b for p in pages for b in p]
    out = np.zeros((len(flat), PATH_SLOTS + WORD_SLOTS + MEASURES), dtype=np.float32)
    if not flat:
        return out
    rows = np.repeat(np.arange(len(flat)), [len(b.path) for b in flat])
    out[rows, np.fromiter((s for b in flat for s in b.path), dtype=np.int64, count=len(rows))] = 1.0
    raw = [b.text.encode() for b in flat]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    starts, ends, first = wb.spans(data, offsets, wb.ALNUM)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(flat)), n_words)
    slot = (wb.hashes(data, starts, ends, fold=True) >> np.uint64(58)).astype(np.int64)
    words = np.bincount(owner * WORD_SLOTS + slot, minlength=len(flat) * WORD_SLOTS).reshape(len(flat), WORD_SLOTS)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = np.minimum(0.25, words / np.maximum(1, n_words)[:, None])
    chars = np.diff(offsets)
    m = out[:, PATH_SLOTS + WORD_SLOTS :]
    m[:, 0] = np.log1p(n_words) / 5
    m[:, 1] = [min(1.0, b.linked / max(1, sum(map(len, b.parts)))) for b in flat]
    m[:, 2] = chars / np.maximum(1, n_words) / 10
    m[:, 3] = [b.text[-1] in ".!?…\"'”»" for b in flat]
    m[:, 4] = ["©" in b.text for b in flat]
    m[:, 5] = [b.tag in ("h1", "h2", "h3", "h4") for b in flat]
    m[:, 6] = [b.tag in ("p", "blockquote", "pre") for b in flat]
    m[:, 7] = np.concatenate([np.linspace(0, 1, len(p)) for p in pages if p])
    return np.clip(out, 0, 3)


def label(pages: list[list[Block]], model: lstm.Labeller) -> list[np.ndarray]:
    """For each page, which of its blocks are article text."""
    sizes = [len(p) for p in pages]
    score = model.predict(vectors(pages), sizes)
    return np.split(score > 0.5, np.cumsum(sizes)[:-1])


def main_text(pages: DataFrame, model: lstm.Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    from . import html_pages

    shared = pages.sparkSession.sparkContext.broadcast((model or html_pages.trained()).weights)

    def run(batches):
        labeller = lstm.Labeller(shared.value)
        for batch in batches:
            _, offsets = wb.utf8(batch.column(2))
            for lo, hi in wb.groups(offsets, GROUP_BYTES):
                read = [blocks_of(h or "") for h in batch.column(2).slice(lo, hi - lo).to_pylist()]
                keep = label(read, labeller)
                texts = ["\n".join(b.text for b, k in zip(p, ks.tolist(), strict=True) if k) for p, ks in zip(read, keep, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
