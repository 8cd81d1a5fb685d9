"""All queries of the library with their SQL twins."""

from __future__ import annotations

from postmill.plans import analytics, brushes, categories, parts, people, periods, reports, streams, tables, texts  # noqa: F401  they register their queries
from postmill.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]

flagship = QUERIES["flagship_report"]
