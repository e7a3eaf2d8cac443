import random
from itertools import combinations

from fedspark.llm import minhash

from .cases import SPACE, lower, make, odd_texts, thue_morse


def brute(rows):
    low = -(1 << 63)
    sets = []
    for d, t in rows:
        w = SPACE.findall(lower(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = [d if d is not None else low for d, _ in rows]
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
            x, y = find(ids[i]), find(ids[j])
            parent[max(x, y)] = min(x, y)
    real = lambda x: None if x == low else x
    return sorted(((real(i), len(s), real(find(i)), find(i) == i) for i, s in zip(ids, sets)), key=str)


def test_odd_cases(spark):
    df = make(spark, odd_texts(), extra=True).repartition(4)
    got = minhash.near_duplicates(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_real_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert got == want
    assert sum(not r[3] for r in got) > 50


def test_crowded_buckets(spark):
    """A passage that makes up half of many unrelated texts must not hide the copies among them."""
    r = random.Random(3)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(500):
        own = [word() for _ in range(60)]
        texts.append(" ".join(passage + own))
        if r.random() < 0.2:
            for _ in range(r.randrange(1, 3)):
                other = own[:]
                for _ in range(r.randrange(1, 4)):
                    other[r.randrange(60)] = word()
                texts.append(" ".join(passage + other))
    r.shuffle(texts)
    df = make(spark, texts)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute([(x.doc_id, x.text) for x in df.collect()])


def test_components_of_a_path(spark):
    n = 200
    links = spark.createDataFrame([(min(i, i + 1), max(i, i + 1)) for i in range(n)], "a long, b long")
    out = minhash.components(spark, links).collect()
    assert len(out) == n + 1 and {r.component for r in out} == {0}


def test_empty_table(spark):
    assert minhash.near_duplicates(make(spark, [])).count() == 0


def test_second_centres(spark):
    """Every bucket has a second centre out of its own members, and failed members meet it."""
    rows = [(rid, bucket) for bucket in (5, -7, 1 << 62) for rid in range(40)] + [(99, 3)]
    met = minhash.stars(spark.createDataFrame(rows, "rid long, bucket long"))
    near = {r.bucket: r.near for r in met.collect()}
    assert near == {b: min(range(40), key=lambda x, b=b: x ^ b) for b in (5, -7, 1 << 62)}
    links = spark.createDataFrame([(0, 2), (0, 5)], "a long, b long")
    got = {tuple(r) for r in minhash.second_stars(minhash.unlike(met, links)).collect()}
    assert got == {(c, x) for c in near.values() for x in range(1, 40) if c not in (0, x) and x not in (2, 5)}


def test_hub_in_the_middle(spark):
    """Copies that resemble only their original join it, wherever its doc_id stands."""
    r = random.Random(11)
    word = lambda: f"w{r.randrange(10**7)}"
    for place in ("middle", "last"):
        groups = []
        for _ in range(3):
            hub = [word() for _ in range(400)]
            copies = []
            for _ in range(60):
                other = hub[:]
                start = r.randrange(400)
                for k in range(48):
                    other[(start + k) % 400] = word()
                copies.append(" ".join(other))
            copies.insert(30 if place == "middle" else 60, " ".join(hub))
            groups.append(copies)
        texts = [t for g in zip(*groups, strict=True) for t in g]
        df = make(spark, texts)
        want = brute([(x.doc_id, x.text) for x in df.collect()])
        assert sum(x[3] for x in want) == 3
        assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == want


def test_prefix_join_alone_is_exact(spark, monkeypatch):
    """Without any bucket the prefix-filtered join finds every link."""
    monkeypatch.setattr(minhash, "stars", lambda rows: rows.where("false").selectExpr("bucket", "rid as a", "rid as near", "rid"))
    r = random.Random(5)
    base = [[f"w{r.randrange(10**5)}" for _ in range(n)] for n in (6, 9, 30, 80, 80)]
    texts = []
    for b in base:
        for k in range(40):
            other = b[:]
            for _ in range(k % 4):
                other[r.randrange(len(b))] = f"w{r.randrange(10**5)}"
            texts.append(" ".join(other + b[: k % 9]))
    df = make(spark, texts)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute([(x.doc_id, x.text) for x in df.collect()])


def test_cells_of_a_crowded_shingle(spark, monkeypatch):
    """Texts that meet in cells of pairs of blocks, and packs that are small, give the same links."""
    monkeypatch.setattr(minhash, "stars", lambda rows: rows.where("false").selectExpr("bucket", "rid as a", "rid as near", "rid"))
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "PACKED", 500)
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        other = base[:]
        start = r.randrange(60)
        for k in range(r.randrange(12)):
            other[(start + k) % 60] = word()
        texts.append(" ".join(other))
    texts += [" ".join(word() for _ in range(30)) for _ in range(100)]
    df = make(spark, texts)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute([(x.doc_id, x.text) for x in df.collect()])


def test_words_that_cancel_in_a_polynomial(spark):
    """Texts of Thue-Morse words share no shingle with those of their complements."""
    texts = [" ".join(thue_morse(n, a, b) for n in (1024, 2048, 4096, 8192, 1024, 512)) for a, b in ("ab", "ba")]
    df = make(spark, texts)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute([(x.doc_id, x.text) for x in df.collect()])
