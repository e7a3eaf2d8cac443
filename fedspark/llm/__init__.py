"""Operators for preparing training text: scans, deduplication, extraction, tokens.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
