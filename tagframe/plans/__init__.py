"""Registered queries over the driver's tables."""

from . import catalog, fields, metrics, repair, selection, spatial, streams, timeline  # noqa: F401
from ._registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
