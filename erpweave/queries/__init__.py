"""Registered queries: each runs library operators over a star-schema folder."""

from erpweave.queries.registry import load_all

__all__ = ["load_all"]
