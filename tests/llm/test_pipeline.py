import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from fedspark.llm import bpe, decontaminate, quality

from .cases import SPACE
from .test_minhash import brute as near_brute


def test_run_matches_plain_stages(spark):
    """Every stage on all that its predecessor kept, against plain versions (the robust estimate aside)."""
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    heads = {r[0] for r in near_brute(rows) if r[3]}
    rows = [r for r in rows if r[0] in heads]
    seen, left = set(), []
    for d, t in rows:
        w = SPACE.findall(t)
        gone = set()
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            if k in seen:
                gone.update(range(i, i + 20))
            seen.add(k)
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t
        if text or not gone:
            left.append((d, text))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {r.doc_id for r in decontaminate.find(spark.createDataFrame(left, "doc_id long, text string"), bench).collect()}
    plain = lambda t: " ".join(t.lower().split())
    exact = {d for d, t in left if any(plain(b.text) in plain(t) for b in bench.collect())}
    assert exact <= found
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {}
    for d, t in left:
        if d not in found:
            ids = enc.encode_ordinary(t)
            raw, ends = t.encode(), np.cumsum([0, *(len(enc.decode_single_token_bytes(i)) for i in ids)]).tolist()
            want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest(), sum(raw[e] & 0xC0 == 0x80 for e in ends[:-1]))
    assert out == want


def _odd_rows(spark, repeated=True):
    words = [f"word{i}," for i in range(400)]
    text = lambda a, n=60: " ".join(words[a : a + n]) + "."
    texts = [None, "", " \n ", "too short", text(0), text(0), text(100), text(200) + " " + text(0), "x" * 3_000_000 + " " + text(300, 90)]
    rows = [(i, t, "en" if i % 2 else None, None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, text(150), "en", "s", 1), (6, text(100), None, None, 1), (6, text(100), None, None, 1)] if repeated else []
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_odd_cases_in_every_stage(spark, sf):
    """Nulls, empty and very long texts, repeated rows and doc_ids, clashing names, empty tables."""
    rows, docs = _odd_rows(spark)
    for name in ("spans", "rid", "bucket", "fp", "label", "words", "grp", "kept"):
        docs = docs.withColumn(name, F.lit("x"))
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        got[name] = stage(spark, docs, sf).collect()
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    ids = {name: sorted((r.doc_id for r in out), key=str) for name, out in got.items()}
    # Under 100 sound rows the base rules alone decide.
    assert ids["quality"] == sorted([4, 5, 6, 6, 6, 7, 8, None], key=str)
    # 4 and 5 are equal; the three rows of doc_id 6 are one node.
    assert ids["near_dedup"] == sorted([0, 1, 2, 3, 4, 6, 6, 6, 7, 8, None], key=str)
    # 5 repeats 4 whole and goes; 7 keeps what is its own.
    left = {r.doc_id: r.text for r in got["substring_dedup"]}
    assert 5 not in left and left[7] == rows[7][1].split(". ")[0] + "." and left[8] == rows[8][1]
    assert len(ids["decontamination"]) == len(rows) and len(ids["byte_bpe"]) == len(rows)
    assert {r.doc_id: r.n_tokens for r in got["byte_bpe"]}[1] == 0


def test_other_results_outlive_a_stage(spark, sf):
    """A stage sweeps the scratch tables of the stage before it, not those of lazy results elsewhere."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = quality.judge(docs)
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES[:2]:
        stage(spark, docs, sf).count()
    assert held.count() == n


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.withColumn("extra", F.lit(1)), sf).columns == docs.columns, name
