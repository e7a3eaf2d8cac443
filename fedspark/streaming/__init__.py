"""Change feeds: polling, classification, and streams with durable offsets."""

from .changes import ChangeConfig, changes_since, classify, collect_changes, drain, watch_changes

__all__ = ["ChangeConfig", "changes_since", "classify", "collect_changes", "drain", "watch_changes"]
