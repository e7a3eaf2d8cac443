"""Types of records.

The lattice: equal types stay; null gives way; structs take the union of their fields;
arrays merge their elements; bigint and double make double; all else makes string.
Fields are sorted by name.  All records of a page are looked at unless told otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

DEEPEST = 10
TRUE_WORDS = frozenset(("true", "1", "yes"))


def infer_type(value, depth: int = 0) -> T.DataType:
    if value is None:
        return T.NullType()
    if depth > DEEPEST:
        return T.StringType()
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, bytes | bytearray):
        return T.BinaryType()
    if isinstance(value, Mapping):
        if not value:
            return T.StringType()
        return T.StructType([T.StructField(str(k), infer_type(value[k], depth + 1)) for k in sorted(value, key=str)])
    if isinstance(value, list | tuple):
        if not value:
            return T.ArrayType(T.StringType())
        merged: T.DataType = T.NullType()
        for v in value:
            merged = merge_types(merged, infer_type(v, depth + 1))
        return T.ArrayType(merged)
    return T.StringType()


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        left, right = ({f.name: f.dataType for f in s.fields} for s in (a, b))
        return T.StructType([T.StructField(n, merge_types(left.get(n, T.NullType()), right.get(n, T.NullType()))) for n in sorted({*left, *right})])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def _settled(t: T.DataType) -> T.DataType:
    """Types never seen become string."""
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields])
    return t


def infer_schema(records: Iterable[Mapping], sample: int | None = None) -> T.StructType:
    """The schema of records; ``sample`` takes that many, evenly spread, first and last included."""
    rows = list(records)
    if sample is not None and len(rows) > sample > 1:
        rows = [rows[i * (len(rows) - 1) // (sample - 1)] for i in range(sample)]
    merged: T.DataType = T.StructType([])
    for r in rows:
        t = infer_type(r)
        if isinstance(t, T.StructType):
            merged = merge_types(merged, t)
    return _settled(T.StructType(sorted(merged.fields, key=lambda f: f.name)))


def coerce(value, kind: T.DataType):
    """A value as ``kind``; what cannot be read so is null."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(kind, T.BooleanType):
        if isinstance(value, str):
            return value.strip().lower() in TRUE_WORDS
        return bool(value)
    if isinstance(kind, T.LongType | T.IntegerType):
        try:
            return int(value)
        except (TypeError, ValueError):
            return None
    if isinstance(kind, T.DoubleType | T.FloatType):
        try:
            return float(value)
        except (TypeError, ValueError):
            return None
    if isinstance(kind, T.BinaryType):
        return bytes(value) if isinstance(value, bytes | bytearray) else str(value).encode()
    if isinstance(kind, T.StructType):
        return tuple(coerce(value.get(f.name), f.dataType) for f in kind.fields) if isinstance(value, Mapping) else None
    if isinstance(kind, T.ArrayType):
        return [coerce(v, kind.elementType) for v in value] if isinstance(value, list | tuple) else None
    return value


def row(record: Mapping, schema: T.StructType) -> tuple:
    return tuple(coerce(record.get(f.name), f.dataType) for f in schema.fields)
