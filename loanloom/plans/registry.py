"""All registered queries."""

from __future__ import annotations

from loanloom.plans import queries_data, queries_encode, queries_eval, queries_train  # noqa: F401
from loanloom.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
