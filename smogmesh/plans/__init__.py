"""Registered queries (the readings analyses end to end) and their SQL oracles."""

from smogmesh.plans.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
