"""Queries over the star schema, with their SQL."""
