"""Helpers to compare frames in tests."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
