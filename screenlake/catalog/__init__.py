"""Queries over the sample tables, one per operator, each with SQL giving the same rows."""

from __future__ import annotations

from screenlake.catalog import batch, checks, files, live, packing, rollups, screening
from screenlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batch", "checks", "files", "live", "packing", "rollups", "screening"]
