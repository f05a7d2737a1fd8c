"""All checks, collected."""

from __future__ import annotations

from checks import gold_checks, layer_checks, silver_checks, stream_checks  # noqa: F401  (register on import)
from checks.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
