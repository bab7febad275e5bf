"""All queries of the library and their SQL."""

from __future__ import annotations

from . import decision_queries, engine_sql, hyphen_queries, model_queries, page_sql, queries, rule_queries, run_queries, structure_queries, text_queries

QUERIES = queries.QUERIES
ORACLES = queries.ORACLES

__all__ = ["ORACLES", "QUERIES", "decision_queries", "engine_sql", "hyphen_queries", "model_queries", "page_sql", "queries", "rule_queries", "run_queries", "structure_queries", "text_queries"]
