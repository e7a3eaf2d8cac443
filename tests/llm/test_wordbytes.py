import random

import numpy as np

from fedspark.llm import wordbytes as wb

from .cases import thue_morse


def hashed(words, fold=False):
    raw = [w.encode() for w in words]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    size = np.array([len(w) for w in raw])
    starts = np.cumsum(size + 1) - size - 1
    return wb.hashes(data, starts, starts + size, fold)


def test_words_that_cancel_in_a_polynomial():
    """A Thue-Morse word and its complement, of letters or of eight letters, have hashes of their own."""
    words = []
    for n in (8, 64, 1024, 2048, 4096):
        for a, b in (("a", "b"), ("aaaaaaaa", "bbbbbbbb"), ("abcdefgh", "bacdefgh")):
            words += [thue_morse(n, a, b), thue_morse(n, b, a)]
    assert len(set(hashed(words).tolist())) == len(set(words))


def test_hashes_tell_words_apart():
    r = random.Random(1)
    words = {"".join(r.choice("ab\0é日") for _ in range(r.randrange(1, 40))) for _ in range(50_000)} | {"a" * n for n in range(1, 400)} | {"\0" * n for n in range(1, 40)}
    words = sorted(words)
    got = hashed(words)
    assert len(set(got.tolist())) == len(words)
    assert hashed(["Abc", "ABCDEFGHIJ", "É"], fold=True).tolist() == hashed(["abc", "abcdefghij", "É"]).tolist()
    assert len({int(x) >> 60 for x in got}) == 16


def test_place_in_the_data_does_not_matter(monkeypatch):
    words = ["alpha", "x", "longer-than-eight", "exactly8", "a" * 5000, "日本語日本語"]
    alone = [int(hashed([w])[0]) for w in words]
    assert hashed(words).tolist() == alone
    monkeypatch.setattr(wb, "PIECE", 10)
    assert hashed(words).tolist() == alone
