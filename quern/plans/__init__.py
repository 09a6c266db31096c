"""Registered queries over the driver's tables and their DuckDB oracle SQL."""

from quern.plans.oracle import ORACLE_SQL
from quern.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
