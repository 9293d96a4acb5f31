"""All queries over the driver's tables, with their SQL."""

from __future__ import annotations

from tidemark.plans import analyses, analytics, documents, indexes, ledgers, measures, options, services, windows  # noqa: F401  they enter their queries
from tidemark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
