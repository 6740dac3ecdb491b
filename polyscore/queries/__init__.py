"""Registered queries: each pairs a Spark plan with its DuckDB oracle SQL."""

from polyscore.queries.registry import REGISTRY, register  # noqa: F401
