"""Spark's pushed filters as (column, operator, value), and their forms in remote languages.

A source may enforce any subset: every filter is also given back to Spark, which checks
it again on the rows that come.
"""

from __future__ import annotations

import datetime
import decimal
from dataclasses import dataclass

from pyspark.sql import datasource as D


@dataclass(frozen=True)
class Predicate:
    column: str
    op: str
    value: object = None


_SIMPLE = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<=", D.StringStartsWith: "starts", D.StringEndsWith: "ends", D.StringContains: "contains"}


def predicate(f: D.Filter) -> Predicate | None:
    """The filter in our form; None where no remote language has it."""
    if isinstance(f, D.Not):
        inner = predicate(f.child)
        if inner and inner.op == "=":
            return Predicate(inner.column, "!=", inner.value)
        return None
    if len(f.attribute) != 1:  # nested fields stay with Spark
        return None
    column = f.attribute[0]
    if isinstance(f, D.In):
        return Predicate(column, "in", tuple(v for v in f.value if v is not None))
    if isinstance(f, D.IsNull):
        return Predicate(column, "null")
    if isinstance(f, D.IsNotNull):
        return Predicate(column, "not null")
    op = _SIMPLE.get(type(f))
    return Predicate(column, op, f.value) if op and f.value is not None else None


def literal(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, datetime.datetime | datetime.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    return str(v)


def quoted(v, quote: str = "'") -> str:
    if isinstance(v, bool | int | float | decimal.Decimal):
        return literal(v)
    return quote + literal(v).replace("\\", "\\\\").replace(quote, "\\" + quote) + quote


def servicenow(p: Predicate) -> str | None:
    """Encoded query; values with its separator are not sent."""
    if p.value is not None and any(c in literal(v) for v in (p.value if p.op == "in" else (p.value,)) for c in "^,"):
        return None
    form = {"=": "{c}={v}", "!=": "{c}!={v}", ">": "{c}>{v}", ">=": "{c}>={v}", "<": "{c}<{v}", "<=": "{c}<={v}", "starts": "{c}STARTSWITH{v}", "ends": "{c}ENDSWITH{v}", "contains": "{c}LIKE{v}", "null": "{c}ISEMPTY", "not null": "{c}ISNOTEMPTY"}
    if p.op == "in":
        return f"{p.column}IN{','.join(map(literal, p.value))}"
    return form[p.op].format(c=p.column, v=literal(p.value)) if p.op in form else None


def soql(p: Predicate) -> str | None:
    """SOQL; dates without quotes."""
    q = lambda v: literal(v) + ("Z" if isinstance(v, datetime.datetime) and v.tzinfo is None else "") if isinstance(v, datetime.date) else quoted(v)
    like = lambda v: str(v).replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("'", "\\'")
    if p.op in ("=", "!=", ">", ">=", "<", "<="):
        return f"{p.column} {p.op} {q(p.value)}"
    if p.op == "in":
        return f"{p.column} IN ({', '.join(q(v) for v in p.value)})" if p.value else None
    if p.op in ("starts", "ends", "contains"):
        return f"{p.column} LIKE '{'' if p.op == 'starts' else '%'}{like(p.value)}{'' if p.op == 'ends' else '%'}'"
    return f"{p.column} {'=' if p.op == 'null' else '!='} null"


def jql(p: Predicate) -> str | None:
    """JQL; text search is fuzzy there, so it is never sent for LIKE."""
    if p.op in ("=", "!=", ">", ">=", "<", "<="):
        return f"{p.column} {p.op} {quoted(p.value, chr(34))}"
    if p.op == "in":
        return f"{p.column} IN ({', '.join(quoted(v, chr(34)) for v in p.value)})" if p.value else None
    return {"null": f"{p.column} IS EMPTY", "not null": f"{p.column} IS NOT EMPTY"}.get(p.op)


def parameters(predicates: list[Predicate]) -> dict[str, str]:
    """Query parameters: equality only, one value a column."""
    out: dict[str, str] = {}
    for p in predicates:
        if p.op == "=":
            out.setdefault(p.column, literal(p.value))
    return out
