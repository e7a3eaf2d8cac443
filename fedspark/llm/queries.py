"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import ship
from . import bpe, decontaminate, html_extract, language_id, license_scan, minhash, quality, sharding, substring_dedup, token_counts

ALPHABET = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where the files give fewer scan tasks than there are cores.

    A table of one small file would else be worked on by one core; a large one has more
    splits than cores and stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer(path: str | None = None) -> str:
    """The byte-level tokenizer of the queries, from a rank file (a parameter; none is kept here)."""
    import public_tokenizers

    return bpe.build(bpe.read_ranks(path or tokenizer_file("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op1(spark, sf):
    return license_scan.scan(_spread(_read(spark, sf, "documents")))


def op2(spark, sf):
    return substring_dedup.remove_repeats(_spread(_read(spark, sf, "documents")), digest=True)


def op3(spark, sf):
    return html_extract.main_text(_spread(_read(spark, sf, "pages")))


def op4(spark, sf):
    return language_id.identify(_spread(_read(spark, sf, "documents")))


def op5(spark, sf):
    return bpe.round_trip(_spread(_read(spark, sf, "documents")), byte_tokenizer())


def op6(spark, sf):
    return sharding.shard(_read(spark, sf, "documents"))


def op7(spark, sf):
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        return token_counts.count_tokens(_spread(_read(spark, sf, "documents")), f.read())


def op8(spark, sf):
    return decontaminate.find(_spread(_read(spark, sf, "documents")), _read(spark, sf, "benchmark"))


def op9(spark, sf):
    return minhash.near_duplicates(_spread(_read(spark, sf, "documents")))


def op10(spark, sf):
    return quality.judge(_spread(_read(spark, sf, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1,
        "op2_substring_dedup": op2,
        "op3_html_extraction": op3,
        "op4_language_id": op4,
        "op5_byte_bpe": op5,
        "op6_sharding": op6,
        "op7_token_counts": op7,
        "op8_decontamination": op8,
        "op9_minhash_dedup": op9,
        "op10_quality_rules": op10,
    }


def _license_sql() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(f"({i}, {quoted(label)}, {quoted(text.lower())})" for i, (label, text) in enumerate(license_scan.TEMPLATES))
    phrases = ", ".join(f"({quoted(label)}, {quoted(p)})" for p, label in license_scan.PHRASES.items())
    return f"""
WITH low AS (SELECT doc_id, {ALPHABET.format("coalesce(text, '')")} AS t FROM documents),
d AS (SELECT doc_id, {words.format("t")} AS w FROM low),
phrases AS (SELECT label, string_split(p, ' ') AS pw FROM (VALUES {phrases}) v(label, p)),
places AS (SELECT doc_id, label, i - 1 AS place FROM d, phrases, unnest(range(1, len(w) + 1)) u(i) WHERE w[i:i + len(pw) - 1] = pw),
base AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
tokens AS (SELECT DISTINCT id, label, unnest({words.format("t")}) AS word FROM (VALUES {templates}) v(id, label, t)),
sizes AS (SELECT id, count(*) AS n, any_value(len({words.format("t")})) AS width FROM tokens JOIN (VALUES {templates}) v(id, l, t) USING (id) GROUP BY id),
hits AS (SELECT doc_id, i AS place, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) u(i) WHERE w[i] IN (SELECT word FROM tokens)),
spots AS (SELECT doc_id, place, id, label, word FROM hits JOIN tokens USING (word)),
-- A block that shares most may be taken to begin at a word of the template.
found AS (SELECT a.doc_id, a.label, count(DISTINCT b.word) / any_value(s.n) AS score FROM spots a JOIN sizes s ON s.id = a.id
          JOIN spots b ON b.doc_id IS NOT DISTINCT FROM a.doc_id AND b.id = a.id AND b.place BETWEEN a.place AND a.place + s.width - 1
          GROUP BY a.doc_id, a.id, a.label, a.place HAVING count(DISTINCT b.word) >= 0.8 * any_value(s.n) - 1e-9),
every AS (SELECT doc_id, label, score FROM found UNION ALL SELECT doc_id, label, 1.0 FROM places),
best AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM every GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.lo::BIGINT AS first_word, base.hi::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(best.labels, '') AS labels, coalesce(best.score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


_WORDS = r"list_filter(regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) u(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, unnest(range(0, 20)) u(j)),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) u(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(ALPHABET.format("text"))} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(2, len(w) - 3))) u(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(c, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _license_sql(), "op2_substring_dedup": _SUBSTRING_SQL, "op9_minhash_dedup": _NEAR_SQL}
