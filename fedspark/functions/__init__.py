"""Function shims and user-defined functions.

``register`` adds the names that other SQL engines have and Spark lacks, as SQL
functions where an expression will do (they are inlined by the optimizer) and as
Arrow-batched functions only where none does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: name: (parameters, type, expression)
SHIMS = {
    "array_length": ("a ARRAY<STRING>", "BIGINT", "CAST(size(a) AS BIGINT)"),
    "list_contains": ("a ARRAY<STRING>, x STRING", "BOOLEAN", "array_contains(a, x)"),
    "string_split": ("s STRING, d STRING", "ARRAY<STRING>", "split(s, concat('\\\\Q', d, '\\\\E'))"),
    "strpos": ("s STRING, t STRING", "BIGINT", "CAST(instr(s, t) AS BIGINT)"),
    "json_extract": ("j STRING, p STRING", "STRING", "get_json_object(j, p)"),
    "json_extract_string": ("j STRING, p STRING", "STRING", "get_json_object(j, p)"),
    "regexp_matches": ("s STRING, p STRING", "BOOLEAN", "s RLIKE p"),
    "date_diff_days": ("a DATE, b DATE", "BIGINT", "CAST(datediff(b, a) AS BIGINT)"),
}


def register(spark: SparkSession) -> None:
    """Add the shims as temporary SQL functions of the session."""
    for name, (parameters, kind, expression) in SHIMS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {expression}")


def time_bucket(width: str, ts: str | Column) -> Column:
    """Start of the bucket of ``width`` that holds ``ts``."""
    return F.window(F.col(ts) if isinstance(ts, str) else ts, width).start


def vowels():
    """A scalar Arrow-batched function: vowels in a text."""

    @F.pandas_udf("long")
    def count(s):
        return s.fillna("").str.count("[aeiouAEIOU]").astype("int64")

    return count


def words_by(docs: DataFrame, key: str) -> DataFrame:
    """A grouped function: words in the texts of each key, folded per partition first.

    ``mapInArrow`` sums what a task reads, so one row a key and task is shuffled.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def fold(batches):
        sums: dict = {}
        for b in batches:
            n = pc.list_value_length(pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.fill_null(b.column(1), ""))))
            empty = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(pc.fill_null(b.column(1), ""))), 0)
            for k, c, e in zip(b.column(0).to_pylist(), n.to_pylist(), empty.to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + (0 if e else c)
        yield pa.RecordBatch.from_pydict({"k": pa.array(list(sums), pa.string()), "n": pa.array(list(sums.values()), pa.int64())})

    return docs.select(F.col(key).cast("string"), "text").mapInArrow(fold, "k string, n long").groupBy(F.col("k").alias(key)).agg(F.sum("n").alias("n"))


def split_lines():
    """A table function: the lines of a text with their numbers."""

    @F.udtf(returnType="line_no: bigint, line: string")
    class SplitLines:
        def eval(self, text: str):
            for i, line in enumerate((text or "").split("\n")):
                yield i, line

    return SplitLines
