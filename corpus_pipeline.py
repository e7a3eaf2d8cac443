"""A training-data pipeline: quality rules, near-dedup, substring dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's docs.  All but the last keep the columns of
``documents``.  When a stage begins, the one before has been written, so the scratch
tables of that one go; no others do.

Defined cases, by stage: a null text has no words and goes with the quality rules (as do
all texts under ten words); null lang and source are groups of their own; a null doc_id
counts as the smallest and passes through; rows that share a doc_id are judged one by one
by the rules and the benchmark, together by near-dedup (one node; the doc_id stays if it is the
least of its class, with all its rows); extra columns are dropped before the first stage; an
empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fedspark import workdir
from fedspark.llm import bpe, decontaminate, minhash, quality, scratch, substring_dedup
from fedspark.llm.queries import byte_tokenizer
from fedspark.ship import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Byte-level BPE ids are not expressible in SQL.
ORACLE_SQL = None


@contextmanager
def _stage(spark: SparkSession) -> Iterator[None]:
    ship(spark)
    scratch.sweep(spark, __name__)  # the stage before has been written
    with scratch.owned(__name__):
        yield


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the outlier test reject go."""
    with _stage(spark):
        return quality.keep(docs.select(COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the least doc_id stays."""
    with _stage(spark):
        return minhash.keep(docs.select(COLUMNS))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a 20-word window that also stands earlier go, and texts of which nothing is left."""
    with _stage(spark):
        return substring_dedup.clean(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to its edit budget, go."""
    with _stage(spark):
        return decontaminate.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text that is left, counted, hashed and decoded again."""
    with _stage(spark):
        return bpe.round_trip(docs, byte_tokenizer())


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base, before = f"{scratch.shared_dir(spark)}/fedspark-pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
        if before:  # only the last stage's input is still needed
            workdir.delete(spark, before)
        before = f"{base}/{name}"
    scratch.sweep(spark, __name__)
    return STAGES[-1][1](spark, docs, sf_dir)
