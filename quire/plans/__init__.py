"""Registered queries."""

from . import archive, geometry, pages, rollups, series, streams, texts  # noqa: F401
from .catalog import CATALOG

__all__ = ["CATALOG"]
