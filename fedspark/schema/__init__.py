"""Schemas of JSON-like records: inference, coercion, evolution, and a cache."""

from .infer import coerce, infer_schema, infer_type, merge_types
from .evolve import SchemaCache, diff, evolve, fingerprint

__all__ = ["SchemaCache", "coerce", "diff", "evolve", "fingerprint", "infer_schema", "infer_type", "merge_types"]
