"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from sieveline.plans import more, parties, records, reports, units, values  # noqa: F401  (they register their queries)
from sieveline.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
