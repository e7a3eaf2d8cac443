"""Operators that Spark SQL has no syntax for."""

from .joins import asof_join, positional_join, range_join, salted_join, semi_join_reduce, union_by_name

__all__ = ["asof_join", "positional_join", "range_join", "salted_join", "semi_join_reduce", "union_by_name"]
