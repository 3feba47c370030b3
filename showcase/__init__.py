"""Queries over the given tables, one or more per operator."""

from showcase import casts, cleansing, files, loads, merges
from showcase.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "casts", "cleansing", "files", "loads", "merges"]
