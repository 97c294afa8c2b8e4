"""Queries over the driver's tables: one per operator, each with its SQL counterpart."""

from gallery import builds, columns, files, relations, tables  # noqa: F401  (they register their queries)
from gallery.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
