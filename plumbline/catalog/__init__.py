"""Queries over the driver tables, each with the SQL that must give the same rows."""

from plumbline.catalog import drift, ingest, learning, metrics, quality, stored  # noqa: F401
from plumbline.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
