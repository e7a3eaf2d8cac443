import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fedspark.llm import quality

from .cases import SPACE, make, odd_texts


def base(text):
    words = SPACE.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def check(df):
    got = {(r[0], i): tuple(r)[1:7] for i, r in enumerate(quality.judge(df).drop("kept", "distance").orderBy("doc_id", "n_words", "word_chars", "n_symbols").collect())}
    want = sorted(((r.doc_id, *base(r.text)) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1:4]))
    assert list(got.values()) == [w[1:] for w in want]


def test_base_statistics(spark):
    texts = odd_texts() + ["a b c d e a b c d e f", "x\n\nx\nx \n y\ny", "#a *b $$ %", "one two three four five six seven eight nine ten"]
    check(make(spark, texts, extra=True))


def test_real_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_outliers(spark):
    """Rows of one kind stay; the few that are set apart go."""
    r = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "eps", "Zeta", "eta,", "theta.", "iota", "kappa"]
    texts = [" ".join(r.choice(words) + str(r.integers(0, 999)) for _ in range(r.integers(60, 200))) for _ in range(400)]
    junk = ["### ".join(t.split()) for t in texts[:20]]
    df = make(spark, texts + junk).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string")})
    out = {x.doc_id: x for x in quality.judge(df).collect()}
    assert sum(not out[i].kept for i in range(400)) <= 2
    assert all(not out[400 + i].kept for i in range(20))
    assert quality.keep(df).columns == df.columns
    assert {x.doc_id for x in quality.keep(df).collect()} == {i for i in out if out[i].kept}


def test_labels(spark):
    d = "/root/testdata/sf0.1"
    out = quality.judge(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed")
    good, bad = (out.where(F.col("quality") == q).agg(F.avg(F.col("kept").cast("double"))).first()[0] for q in (1, 0))
    assert good > 0.995 and bad < 0.05


def test_empty_table(spark):
    assert quality.judge(make(spark, [])).count() == 0


def test_plan_has_no_python(spark, sf):
    plan = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_few_rows_of_a_rare_language_get_a_distance(spark):
    """Rows left in groups too small for an estimate are held against all sound rows."""
    import random

    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9)))
    text = lambda: " ".join(word() for _ in range(r.randrange(80, 120))) + "."
    rows = [(i, text(), "en", "web") for i in range(300)] + [(1000 + i, text(), "fr", "web") for i in range(9)]
    rows.append((2000, " ".join(f"{word().upper()}###$$$%%%!!!{i}" for i in range(100)), "fr", "web"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    got = {x.doc_id: x for x in quality.judge(df).collect()}
    assert len(got) == 310 and all(x.distance is not None for x in got.values())
    assert not got[2000].base_failed and not got[2000].kept
    assert sum(got[1000 + i].kept for i in range(9)) >= 7


FLOORS = np.array([f for f, _ in quality.FEATURES.values()], dtype=float)


def mcd(x, picks):
    """Squared distances of all rows by the estimate of the docstring, in plain numpy."""
    p = x.shape[1]

    def distances(m, c, of=x):
        l = np.zeros((p, p))
        for j in range(p):
            l[j, j] = np.sqrt(max(c[j, j] - l[j, :j] @ l[j, :j], 1.0))
            for i in range(j + 1, p):
                l[i, j] = (c[i, j] - l[i, :j] @ l[j, :j]) / l[j, j]
        z = np.linalg.solve(l, (of - m).T)
        return (z * z).sum(axis=0), 2 * np.log(np.diag(l)).sum()

    def of_rows(rows, scale):
        m = rows.mean(axis=0)
        return m, scale * ((rows.T @ rows) / len(rows) - np.outer(m, m)) + np.diag(FLOORS**2)

    def step(m, c, first):
        d2, _ = distances(m, c)
        bins = np.minimum(quality.BINS - 1, np.floor(20 * np.log1p(d2))).astype(int)
        before = np.concatenate([[0], np.cumsum(np.bincount(bins, minlength=quality.BINS))])[:-1]
        there = np.unique(bins)
        core = there[before[there] < quality.CORE * len(x)].max()
        mid = there[before[there] < 0.5 * len(x)].max()
        scale = 1.5 if first else max(1.0, (np.exp((mid + 1) / 20) - 1) / 4.351)
        m, c = of_rows(x[bins <= core], scale)
        return m, c, distances(m, c)[1] - p * np.log(scale)

    middle = np.median(x, axis=0)
    starts = [(middle, np.diag((1.4826 * np.median(np.abs(x - middle), axis=0)) ** 2 + FLOORS**2))]
    starts += [of_rows(x[rows], 1.5) for rows in picks if len(rows)]
    ends = []
    for m, c in starts:
        for k in range(quality.TRIALS):
            m, c, goal = step(m, c, k == 0)
        ends.append((goal, len(ends), m, c))
    _, start, m, c = min(ends, key=lambda e: e[:2])
    for _ in range(quality.STEPS - quality.TRIALS):
        m, c, _ = step(m, c, False)
    return distances(m, c)[0], start


def test_estimate_matches_numpy(spark):
    """kept and distance of every row against a plain version: groups of their own, tied rows, many outliers."""
    r = np.random.default_rng(12)
    words = ["alpha", "beta", "gamma", "Delta", "eps,", "zeta.", "eta", "x", "#", "THETA"]
    rows = []
    for g, (lang, source, n, bad) in enumerate([("en", "web", 300, 60), ("de", None, 220, 90), (None, "x", 150, 5), ("en", "same", 120, 0)]):
        for i in range(n):
            weights = r.dirichlet(np.full(10, 0.3)) if i < bad else np.array([3, 3, 3, 2, 2, 2, 2, 1, 0.05, 0.2]) / 18.25
            k = int(r.integers(20, 120))
            text = " ".join(r.choice(words, p=weights) + (str(r.integers(99)) if r.random() < 0.9 else "") for _ in range(k)) if source != "same" else " ".join(f"word{j}" for j in range(30))
            rows.append((g * 1000 + i, text, lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in quality.judge(df).collect()}
    x_columns = [f"x{i}" for i in range(5)]
    hashes = [F.xxhash64(*x_columns, F.lit(s)).alias(f"h{s}") for s in range(1, quality.STARTS)]
    seen = quality._features(quality.statistics(df)).select("doc_id", "base_failed", *x_columns, *hashes).collect()
    chosen = set()
    for g in range(4):
        mine = [s for s in seen if s.doc_id // 1000 == g]
        sound = [s for s in mine if not s.base_failed]
        x = np.array([[s[c] for c in x_columns] for s in sound], dtype=float)
        every = max(1, len(sound) // quality.SUBSET)
        picks = [[i for i, s in enumerate(sound) if s[f"h{k}"] % every == 0] for k in range(1, quality.STARTS)]
        d2, start = mcd(x, picks)
        chosen.add(start)
        assert np.allclose([got[s.doc_id].distance for s in sound], d2, rtol=1e-6, atol=1e-6)
        assert [got[s.doc_id].kept for s in sound] == (d2 <= quality.CUTOFF).tolist()
        assert not any(got[s.doc_id].kept for s in mine if s.base_failed)
    assert len(chosen) > 1 and sum(not v.kept for v in got.values()) > 50


def test_small_groups_are_a_parameter(spark):
    """Below the least group in all, the base rules alone decide."""
    df = make(spark, odd_texts())
    out = quality.judge(df, least_group=10**6).collect()
    assert all(x.distance is None and x.kept == (not x.base_failed) for x in out)


def test_very_long_and_tied_texts(spark):
    texts = ["word of a story that goes on. " * 60_000] + ["the very same text of some ten words in a row, told."] * 150
    out = {x.doc_id: x for x in quality.judge(make(spark, texts).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))).collect()}
    assert out[0].n_words == 420_000 and out[0].base_failed
    assert len({(out[i].kept, out[i].distance) for i in range(1, 151)}) == 1
