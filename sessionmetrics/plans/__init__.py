"""Query catalogue, oracle SQL and the batch job."""

from .catalog import queries
from .oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]
