"""As-of, range, positional, salted and semi-join-reduced joins as DataFrame compositions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str], columns: list[str], tie: str | None = None, width: float | None = None) -> DataFrame:
    """Each left row with ``columns`` of the last right row of its ``by`` group whose ``on`` is not later.

    One shuffle on ``by``: both sides are put in one stream, and the last right value so
    far is carried along a window.  Rows without a match, or with a null in ``by`` or
    ``on``, keep nulls; of right rows with equal ``on`` the one with the greatest ``tie``
    counts.

    With ``width`` (seconds, or units of ``on``) a group is cut into slices of that width,
    each a partition of its own; what a slice begins with comes from the last right rows
    of the slices before, one row a slice.  So a hot group is spread over all tasks.
    """
    right = right.dropna(subset=[*by, on])
    payload = F.struct(*[F.col(c) for c in columns])
    low = F.col(tie) if tie else F.lit(0)
    lefts = left.select(*by, on, F.lit(1).alias("_side"), F.lit(None).cast(low_type(right, tie)).alias("_tie"), F.struct(*[F.col(c) for c in left.columns]).alias("_row"), F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_seen"))
    rights = right.select(*by, on, F.lit(0).alias("_side"), low.cast(low_type(right, tie)).alias("_tie"), F.lit(None).cast(lefts.schema["_row"].dataType).alias("_row"), payload.alias("_seen"))
    stream = lefts.unionByName(rights)
    keys = list(by)
    if width:
        stream = stream.withColumn("_slice", F.floor(_number(dict(left.dtypes), on) / width))
        keys.append("_slice")
    w = Window.partitionBy(*keys).orderBy(F.col(on), F.col("_side"), F.col("_tie")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stream.withColumn("_last", F.last("_seen", ignorenulls=True).over(w)).where("_side = 1")
    if width:
        ends = stream.groupBy(*keys).agg(F.max_by("_seen", F.when(F.col("_side") == 0, F.struct(on, "_tie"))).alias("_end"))
        before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*keys, F.last("_end", ignorenulls=True).over(before).alias("_carried")).where("_carried is not null")
        out = out.join(carried, keys, "left").withColumn("_last", F.coalesce("_last", "_carried"))
    names = [F.col(f"_last.{c}").alias(c if c not in left.columns else f"right_{c}") for c in columns]
    return out.select("_row.*", *names)


def _number(kinds: dict[str, str], c: str) -> Column:
    """A column as a double; times as seconds."""
    time = kinds[c] in ("timestamp", "timestamp_ntz", "date")
    return F.unix_timestamp(F.col(c).cast("timestamp")).cast("double") if time else F.col(c).cast("double")


def low_type(right: DataFrame, tie: str | None) -> str:
    return right.schema[tie].dataType.simpleString() if tie else "int"


def range_join(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, width: float) -> DataFrame:
    """points x spans with start <= point < end, as an equi-join on buckets of ``width``.

    A span is copied to every bucket it touches, so choose ``width`` near the usual span;
    no pair of rows is compared that does not share a bucket.
    """
    kinds = {**dict(points.dtypes), **dict(spans.dtypes)}
    value = lambda c: _number(kinds, c)
    p = points.withColumn("_bucket", F.floor(value(point) / width))
    s = spans.where(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(F.floor(value(start) / width), F.floor(value(end) / width))))
    return p.join(s, "_bucket").where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_bucket")


def positional_join(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Row k of ``left`` beside row k of ``right``; the longer side is kept with nulls."""
    a = _numbered(left, left_order)
    b = _numbered(right, right_order)
    return a.join(b, "_row_number", "full").drop("_row_number")


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Global row numbers without one big task: range partitions, sorted, plus the counts before each.

    The sorted rows are kept in the shared folder, so that counting and numbering see
    the same partitions.
    """
    from .. import workdir

    spark = df.sparkSession
    path = workdir.fresh(spark, "numbered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    part = F.shiftright("_at", 33)
    before, n = [], 0
    for r in sorted(stored.groupBy(part.alias("p")).count().collect()):
        before.append((r["p"], n))
        n += r["count"]
    starts = spark.createDataFrame(before, "_part long, _start long")
    return stored.withColumn("_part", part.cast("long")).join(F.broadcast(starts), "_part").withColumn("_row_number", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_start", "_at")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salts: int, how: str = "inner") -> DataFrame:
    """Equi-join with a hot key on the left dealt over ``salts`` tasks; the right side is copied so often.

    A row's salt is a hash of the row, so a task that runs again deals its rows as before.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat rows of the right side")
    a = left.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, kind in left.dtypes if "map<" not in kind and kind != "variant"]), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return a.join(b, [*on, "_salt"], how).drop("_salt")


@dataclass
class Reduction:
    """What a semi-join reduction did, for the plan report."""

    applied: bool
    keys: int
    reason: str


def semi_join_reduce(small: DataFrame, remote: DataFrame, small_key: str, remote_key: str, most_rows: int = 10_000, most_keys: int = 2_000, how: str = "inner") -> tuple[DataFrame, Reduction]:
    """``remote`` restricted to the distinct keys of ``small``, where these are few enough to send.

    Only for joins that drop unmatched remote rows.  Both caps are looked at with bounded
    reads; beyond them the join runs unreduced, with the same rows.
    """
    if how not in ("inner", "left_semi", "left"):
        return remote, Reduction(False, 0, f"a {how} join keeps unmatched remote rows")
    if small.limit(most_rows).count() >= most_rows:
        return remote, Reduction(False, 0, f"the small side has {most_rows} rows or more")
    keys = [r[0] for r in small.select(small_key).where(F.col(small_key).isNotNull()).distinct().limit(most_keys).collect()]
    if len(keys) >= most_keys:
        return remote, Reduction(False, len(keys), f"{most_keys} keys or more")
    return remote.where(F.col(remote_key).isin(keys)), Reduction(True, len(keys), "keys sent as IN")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL BY NAME: missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def high_water_mark(df: DataFrame, column: str | Column):
    """The greatest value of a column (None for an empty table)."""
    return df.agg(F.max(column)).first()[0]
