"""Small tables with the awkward cases that every operator must handle."""

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def make(spark, texts, extra=False):
    """texts: list of text or (doc_id, text)."""
    rows = []
    for i, t in enumerate(texts):
        d, t = t if isinstance(t, tuple) else (i, t)
        rows.append((d, t, "en" if i % 3 else None, f"src{i % 2}" if i % 5 else None, len(t) if t is not None else None))
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("fp", "rid", "spans", "bucket", "label", "n", "words", "size", "grp", "kind"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def odd_texts(seed=0):
    r = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "straße", "été", "x", "the", "The", "日本", "a,b", "zz z", "end."]
    base = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (1, 4, 5, 19, 20, 21, 40, 90, 300)]
    out = [None, "", "   \n\t", *base, *base[3:7], "word " * 70, base[7] + "\n" + base[6], base[6] + "\t\x0b" + base[7]]
    for _ in range(12):
        words = base[8].split()
        words[r.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    out += [(7, base[7]), (7, base[8]), (None, base[7]), (None, None)]
    out.append("long " + " ".join(r.choice(vocabulary) + str(r.randrange(9)) for _ in range(20000)))
    return out


def thue_morse(n, a, b):
    """``n`` letters that cancel against their complement in a polynomial modulo a power of two."""
    return "".join(b if i.bit_count() % 2 else a for i in range(n))
