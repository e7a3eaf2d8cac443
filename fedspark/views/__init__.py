"""Materialized views: versioned Parquet folders behind a pointer file."""

from .store import ViewStore

__all__ = ["ViewStore"]
