import hashlib
from collections import Counter

from fedspark.llm import substring_dedup as sd

from .cases import SPACE, make, odd_texts, thue_morse


def brute(rows):
    first = {}
    low = -(1 << 63)
    listed = [(d if d is not None else low, SPACE.findall(t or "")) for d, t in rows]
    for d, w in listed:
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for (d, _), (key, w) in zip(rows, listed):
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (key, i):
                gone.update(range(i, i + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_odd_cases(spark):
    df = make(spark, odd_texts(), extra=True).repartition(5)
    got = sd.remove_repeats(df, digest=True)
    assert Counter(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_lengthened_prefixes(spark, monkeypatch):
    monkeypatch.setattr(sd, "HEAVY", 0)
    monkeypatch.setattr(sd, "MEMORY_SUFFIXES", 0)
    df = make(spark, odd_texts(3))
    got = sd.remove_repeats(df, digest=True)
    assert Counter(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_real_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = Counter(map(tuple, sd.remove_repeats(df, digest=True).collect()))
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])
    assert sum(r[2] for r in got) > 0


def test_empty_table(spark):
    assert sd.remove_repeats(make(spark, [])).count() == 0


def test_words_that_cancel_in_a_polynomial(spark):
    """Windows of Thue-Morse words repeat no window of their complements."""
    texts = [" ".join(thue_morse(1024 + (i == 7), a, b) for i in range(20)) for a, b in ("ab", "ba")] * 2
    df = make(spark, texts)
    assert Counter(map(tuple, sd.remove_repeats(df, digest=True).collect())) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_colliding_hashes_on_the_map_side(spark, monkeypatch):
    """Repeats settled within a map group are compared on words, so collisions cannot make one."""
    import numpy as np

    texts = [" ".join(f"long-word-{(i * k) % 97}" for i in range(60)) for k in (1, 5, 7)] + ["x" * 30 + " " + " ".join(f"long-word-{i}" for i in range(40))]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    w, words = sd._windows(data, offsets)
    for name in ("anchor", "away", "label"):
        w[name] = w[name] * 0  # every window has one label
    assert sd._earliest(w, np.arange(4)).sum() == 1
    got = sd._earliest(w, np.arange(4), words)
    listed = [t.split() for t in texts]
    lead = tuple(listed[0][:20])
    want = [(r, s) == (0, 0) or tuple(listed[r][s : s + 20]) != lead for r, s in zip(w["row"].tolist(), w["start"].tolist())]
    assert got.tolist() == want and not got.all()


def test_many_rows_of_one_text(spark):
    """Rows equal in doc_id (a null one too) and text share their result."""
    r = __import__("random").Random(4)
    one, two = (" ".join(f"w{r.randrange(50)}" for _ in range(120)) for _ in range(2))
    both = one + " " + two
    texts = [(5, both)] * 60 + [(None, one)] * 40 + [(3, two)] * 3 + [(5, one)]
    df = make(spark, texts).repartition(6)
    assert Counter(map(tuple, sd.remove_repeats(df, digest=True).collect())) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_clean_keeps_columns_whatever_their_names(spark):
    df = make(spark, odd_texts(), extra=True)
    out = sd.clean(df)
    assert out.columns == df.columns and "spans" in out.columns
    rows = out.collect()
    assert rows and all(x.spans == "x" and x.n_chars == (None if x.text is None else len(x.text)) for x in rows)
    assert sd.clean(df.limit(0)).count() == 0


def test_a_text_of_several_megabytes(spark):
    r = __import__("random").Random(6)
    long = " ".join(f"w{r.randrange(10**6)}" for _ in range(900_000))
    part = " ".join(long.split()[400_000:400_050])
    df = make(spark, [long, "before " + part + " after"])
    assert Counter(map(tuple, sd.remove_repeats(df, digest=True).collect())) == brute([(x.doc_id, x.text) for x in df.collect()])
