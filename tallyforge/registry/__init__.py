"""Queries over the given tables, by name, and their SQL."""

from . import files, models, reports, streams  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
