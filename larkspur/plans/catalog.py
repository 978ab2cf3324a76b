"""All registered queries and their SQL checks."""

from __future__ import annotations

from larkspur.plans import model_queries, recommend_queries, source_queries, text_queries  # noqa: F401
from larkspur.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
