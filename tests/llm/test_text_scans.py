import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fedspark.llm import bpe, decontaminate, language_id, license_scan, sharding, token_counts

from .cases import lower, make, odd_texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# licenses


def license_brute(text):
    words = WORD.findall(lower(text or ""))
    places, labels = [], set()
    for p, label in license_scan.PHRASES.items():
        p = p.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    every, score = set(labels), 1.0 if labels else 0.0
    for label, t in license_scan.TEMPLATES:
        listed = WORD.findall(lower(t))
        t = set(listed)
        for i in range(max(1, len(words) - len(listed) + 1)):
            have = len(t.intersection(words[i : i + len(listed)]))
            if have >= 0.8 * len(t) - 1e-9:
                every.add(label)
                score = max(score, have / len(t))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), score


LICENSES = ["Released under the MIT License.\nother", "the mit-License mit LICENSE", "all\nrights reserved", "x All rights reserved 2020", "civil rights are reserved by all", "GNU General Public License, version 3. this work licensed", "apache license, version 2.0 under licensed\n" * 2]
#: Notices as they stand in the heads of files, wrapped over lines.
WRAPPED = {
    "mit": """/*
 * Permission is hereby granted, free of charge, to any person obtaining
 * a copy of this software and associated documentation files (the
 * "Software"), to deal in the Software without restriction, including
 * without limitation the rights to use, copy, modify, merge, publish,
 */""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:""",
    "gpl": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.""",
    "apache": """// You may not use this
// file except in compliance
// with the License. You may obtain a copy of
// the License at""",
}


def test_licenses(spark, sf):
    for df in (make(spark, odd_texts() + LICENSES + list(WRAPPED.values()), extra=True), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        want = sorted(((r.doc_id, *license_brute(r.text)) for r in df.collect()), key=str)
        assert rows(license_scan.scan(df)) == want
    assert license_scan.scan(make(spark, [])).count() == 0


def test_wrapped_notices(spark):
    """A notice has its label whatever lines it is wrapped over; a few of its words in a row do not."""
    texts = [f"int x;\n{t}\nint y;" for t in WRAPPED.values()] + ["civil rights are reserved by all", "all\nrights reserved"]
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan(make(spark, texts)).collect()}
    assert all(label in got[i] for i, label in enumerate(WRAPPED))
    assert got[len(WRAPPED)] == [""] and got[len(WRAPPED) + 1] == ["all-rights-reserved"]


def test_license_words_in_disorder(spark):
    """Template words with repeats, gaps and any order, against brute force."""
    r = np.random.default_rng(3)
    texts = []
    for _ in range(150):
        _, t = license_scan.TEMPLATES[r.integers(len(license_scan.TEMPLATES))]
        words = t.split()
        for _ in range(int(r.integers(0, 8))):
            words.insert(int(r.integers(len(words) + 1)), str(r.choice([*words, "other", "words"])))
        if r.random() < 0.3:
            r.shuffle(words)
        texts.append(" ".join([str(x) for x in r.choice(["the", "of", "this", "zzz"], int(r.integers(0, 9)))] + words[int(r.integers(0, 4)) :]))
    df = make(spark, texts)
    assert rows(license_scan.scan(df)) == sorted(((x.doc_id, *license_brute(x.text)) for x in df.collect()), key=str)


# languages


def test_language_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert out[0] > 0.97 and out[1] > 0 and out[2] <= 1


def plain_bucket(gram):
    """Bucket of one n-gram, in plain integers."""
    low, total = 2**32 - 1, 0
    for c in gram:
        total = ((total ^ total >> 15) * 0x2C1B3C6D + ord(c) + 1) & low
    h = ((total + len(gram) * 0x01000193) & low) * 0x9E3779B1 & low
    return ((h ^ h >> 15) * 0x85EBCA77 & low) >> 32 - 14


def plain_grams(text):
    t = text.lower()
    return Counter(plain_bucket(t[i : i + n]) for n in language_id.ORDERS for i in range(len(t) - n + 1))


def plain_bayes(rows):
    """(doc_id, held_out, lang_pred, score) by naive Bayes without numpy's batches."""
    counts = {}
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    for d, t, lang in rows:
        if t is not None and lang is not None and d is not None and not held(d):
            counts.setdefault(lang, Counter()).update(plain_grams(t))
    every = language_id.BUCKETS * language_id.SMOOTHING
    out = []
    for d, t, _ in rows:
        if t is None or not any(c.isalpha() for c in t) or not counts:
            out.append((d, held(d), "und", 0.0))
            continue
        grams = plain_grams(t)
        score = {x: sum(n * math.log((c[b] + language_id.SMOOTHING) / (c.total() + every)) for b, n in grams.items()) for x, c in counts.items()}
        best = max(sorted(score), key=score.get)
        out.append((d, held(d), best, 1 / sum(math.exp(max(-700, s - score[best])) for s in score.values())))
    return sorted(out, key=str)


def test_language_matches_plain_bayes(spark, monkeypatch):
    """Also where languages come in several blocks and texts in several pieces; scripts of 2 and 3 bytes a letter."""
    r = np.random.default_rng(6)
    kinds = {"en": "thequickbrownfx ", "ru": "съешьещёэтих ", "uk": "їжакєґанок ", "ja": "日本語のテキスト ", "el": "ξεσκεπάζω "}
    rows_ = [(i, "".join(r.choice(list(kinds[x]), r.integers(1, 80))), x) for i, x in enumerate(r.choice(list(kinds), 120))]
    rows_ += [(200, None, "en"), (201, "½ ² ٣", "en"), (202, "", "ru"), (203, "İSTANBUL ǅ", None), (None, "the fox", "en"), (204, "x" * 5000, "en"), (204, "x" * 5000, "en"), (205, "12 a", "en")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    want = plain_bayes(rows_)
    for languages, piece in ((250, 1 << 18), (2, 50)):
        monkeypatch.setattr(language_id, "LANGUAGES", languages)
        monkeypatch.setattr(language_id, "PIECE", piece)
        got = rows(language_id.identify(df))
        assert [x[:3] for x in got] == [x[:3] for x in want]
        assert np.allclose([x[3] for x in got], [x[3] for x in want], atol=1e-3)
    held = [(g, x[2]) for g, x in zip(sorted(got, key=lambda y: str(y[0])), sorted(rows_, key=lambda y: str(y[0]))) if g[1] and g[2] != "und" and x[2]]
    assert sum(g[2] == x for g, x in held) >= 0.9 * len(held) > 20


def test_language_of_a_very_long_text(spark):
    df = make(spark, ["A plain sentence of words. " * 200_000, "Ein Satz."] * 3)
    assert all(0 < x[3] <= 1 for x in rows(language_id.identify(df)))


def test_language_odd_cases(spark):
    df = make(spark, odd_texts() + ["123 456", "..."], extra=True)
    out = rows(language_id.identify(df))
    assert len(out) == df.count()
    assert [r[2:] for r in out if r[0] in (0, 1)] == [("und", 0.0)] * 2
    assert language_id.identify(make(spark, [])).count() == 0
    nothing = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r[2] for r in rows(language_id.identify(nothing))} == {"und"}


# byte-level BPE

ODD = ["  two  spaces ", "tabs\t\tand\nlines\n\n", "emoji \U0001f600\U0001f468‍\U0001f469", "don't we'll I'M", "数字123 ４５", "<|endoftext|>", "a" * 500, "▁mark ▁", " ", "   ", "x  ", " nbsp", "é"]


@pytest.fixture(scope="module")
def codec():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.build(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, codec):
    text, want = codec
    for df in (make(spark, odd_texts() + ODD, extra=True), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        expect = []
        for r in df.collect():
            ids = want.encode_ordinary(r.text or "")
            ends = np.cumsum([0, *(len(want.decode_single_token_bytes(i)) for i in ids)]).tolist()
            raw = (r.text or "").encode()
            inside = sum(raw[e] & 0xC0 == 0x80 for e in ends[:-1])
            expect.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest(), inside))
        assert rows(bpe.round_trip(df, text)) == sorted(expect, key=str)
    assert bpe.round_trip(make(spark, []), text).count() == 0


def test_bpe_offsets_and_decoding(spark, codec):
    text, _ = codec
    df = make(spark, ODD)
    encoded = bpe.encode(df, text)
    assert sorted(r.text for r in bpe.decode(encoded, text).collect()) == sorted(ODD)
    c = bpe.Codec.of(text)
    for t in ODD:
        ids = c.encode([t])[0]
        assert "".join(c.decode_stream([[i] for i in ids])) == t
    for r in encoded.join(df, "doc_id").collect():
        assert all(0 <= a <= b <= len(r.text) for a, b in zip(r.starts, r.ends))


def test_bpe_held_pre_tokens(spark, codec, monkeypatch):
    """Starting afresh, code points of newer Unicode versions and single long words change nothing."""
    text, want = codec
    c = bpe.Codec(text)
    r = np.random.default_rng(4)
    letters = list("ab Z'sSt0٣½\n 　é日😀‍՘࢏౜\U00011de1")
    fuzz = ["".join(r.choice(letters, r.integers(0, 40))) for _ in range(3000)] + ["x" * 300_000, "日" * 100_000, ""]
    for limit in (bpe.HELD_BYTES, 1000):
        monkeypatch.setattr(bpe, "HELD_BYTES", limit)
        for lo in range(0, len(fuzz), 100):
            part = fuzz[lo : lo + 100]
            assert c.encode(part) == [want.encode_ordinary(t) for t in part]
    n, _, starts, ends = c.encode_flat(fuzz)
    made = Tokenizer.from_str(text).encode_batch(fuzz, add_special_tokens=False)
    assert list(zip(starts.tolist(), ends.tolist())) == [o for e in made for o in e.offsets]


# sharding


def test_permutation():
    for n in (1, 2, 3, 40, 1000, 4097):
        p = sharding.permute(np.arange(n), n)
        assert sorted(p.tolist()) == list(range(n))
        assert sharding.permute(p, n, back=True).tolist() == list(range(n))
    assert sharding.row_at(*sharding.place(123, 1000), 1000) == 123


def test_shards(spark):
    for df in (make(spark, odd_texts(), extra=True), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        out = sharding.shard(df.repartition(7)).collect()
        n = df.count()
        assert len(out) == n
        slots = {}
        for r in out:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert max(map(len, slots.values())) - min([len(slots.get(s, [])) for s in range(40)]) <= 1
        key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[1])
        want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect()), key=key)
        assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=key) == want
        number = {sharding.row_at(r.shard, r.slot, n): (r.doc_id, r.size, r.text_crc32) for r in out}
        assert [number[i] for i in range(n)] == want
    assert sharding.shard(make(spark, [])).count() == 0


# token counts


def test_token_counts(spark, monkeypatch):
    proto = open(P.path("piece_bpe_32k.model"), "rb").read()
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    r = np.random.default_rng(5)
    letters = list("ab \n\téß日 ▁  .,<s>")
    fuzz = ["".join(r.choice(letters, r.integers(0, 60))) for _ in range(400)]
    for df in (make(spark, odd_texts() + ODD + fuzz, extra=True), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        want = []
        for x in df.collect():
            n = len(model.encode(x.text or ""))
            want.append((x.doc_id, len((x.text or "").encode()), n, n > 4096))
        assert rows(token_counts.count_tokens(df, proto)) == sorted(want, key=str)
    assert token_counts.count_tokens(make(spark, []), proto).count() == 0


def test_table_probes():
    keys = np.array([1, 2, 3, 1 << 63, (1 << 63) + 5], dtype=np.uint64)
    table = token_counts.build_table(keys, np.array([4, 5, 6, 7, 8]))
    assert token_counts.look_up(np.r_[keys, np.uint64(9)], table).tolist() == [4, 5, 6, 7, 8, 0]


# decontamination


def plain(t):
    return re.sub("[ \t\n\x0b\x0c\r]+", " ", lower(t))


def best_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_decontamination(spark):
    r = np.random.default_rng(2)
    items = [" ".join("".join(r.choice(list("abcdefgh"), r.integers(2, 8))) for _ in range(n)) for n in (9, 14, 25, 40)]
    rows_ = [(i, t) for i, t in enumerate(items)] + [(8, "short"), (9, None), (10, items[0].upper()), (11, "日本語のテキストを読む人"), (12, "x y"), (13, "é"), (14, "  "), (15, "ab" * 30), (16, "twenty characters ok")]
    bench = spark.createDataFrame(rows_, "item_id long, text string")

    def edited(t, k):
        t = list(t)
        for _ in range(k):
            at = r.integers(len(t))
            t[at : at + r.integers(2)] = r.choice(list("xyz"), r.integers(2)).tolist() if r.integers(2) else []
        return "".join(t)

    filler = lambda: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(30))
    texts = [None, "", "a b", *items, *[filler() + " " + edited(t, int(k * len(t) / 20)) + "\n" + filler() for t in items for k in range(5)], filler(), items[1].replace(" ", "\n\t ")]
    texts += ["SHORT", "a shor t", "前日本語のテキスを読む人後", "日本語テキ読む人", "x \n Y", "caf\u00e9", "ab" * 40, "ab" * 13 + "c" + "ab" * 16, "twenty charters ok", "tenty charters k"]
    got = {(x.doc_id, x.item_id): x.edits for x in decontaminate.find(make(spark, texts, extra=True), bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in rows_:
            p = plain(item or "").strip(" ")
            if t is None or not p:
                continue
            e = best_edits(p, plain(t))
            if e <= decontaminate.budget(len(p))[0]:
                want[d, i] = e
    assert got == want and len(want) > 15
    kept = {x.doc_id for x in decontaminate.clean(make(spark, texts), bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.find(make(spark, []), bench).count() == 0
    assert decontaminate.find(make(spark, texts), bench.limit(0)).count() == 0


def test_decontamination_blocks(spark, sf, monkeypatch):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = rows(decontaminate.find(docs, bench))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARACTERS", 2000)
    assert rows(decontaminate.find(docs, bench)) == whole and whole


def test_decontamination_of_repetitive_texts(monkeypatch):
    """Counted in small parts or not at all, repetitive texts give what a plain alignment gives."""
    r = np.random.default_rng(9)
    items = ["a" * 40, "ab" * 25, "a" * 20 + "b" + "a" * 20, "-" * 60, "".join(r.choice(list("ab"), 50)), "aaab", "b"]
    index = decontaminate.Index(list(enumerate(items)))
    texts = ["".join(r.choice(list("ab"), int(r.integers(1, 200)), p=[p, 1 - p])) for p in (0.5, 0.9, 0.98) for _ in range(12)] + ["a" * 300, "-" * 59, "ab" * 90 + "-" * 70, ""]
    want = {}
    for d, t in enumerate(texts):
        for i, p in enumerate(items):
            e = best_edits(p, t)
            if e <= decontaminate.budget(len(p))[0]:
                want[d, i] = e
    for hits, stretch, dense in ((1 << 20, 4096, 8), (50, 4096, 8), (1 << 20, 16, 1), (64, 32, 0)):
        for name, value in (("HITS", hits), ("STRETCH", stretch), ("DENSE", dense)):
            monkeypatch.setattr(decontaminate, name, value)
        text, item, start, end, edits = index.matches(*decontaminate.normalise(texts))
        assert dict(zip(zip(text.tolist(), item.tolist()), edits.tolist())) == want
        for d, i, a, b, e in zip(text.tolist(), item.tolist(), start.tolist(), end.tolist(), edits.tolist()):
            assert best_edits(items[i], texts[d][max(0, a - e) : b]) == e


def test_decontamination_of_a_long_run_of_one_letter():
    """Memory and time follow the length of the text."""
    index = decontaminate.Index([(1, "a" * 200), (2, "a" * 100 + "b" * 100)])
    points, offsets = decontaminate.normalise(["a" * 1_000_000])
    tracemalloc.start()
    text, item, _, _, edits = index.matches(points, offsets)
    assert (text.tolist(), item.tolist(), edits.tolist()) == ([0], [0], [0])
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
