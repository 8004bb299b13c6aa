"""Registered queries over the test tables, each with a SQL twin for DuckDB."""

from . import finance, freight, people  # noqa: F401  (register their queries)
from .base import REGISTRY

__all__ = ["REGISTRY"]
