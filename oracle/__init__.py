"""Independent SQL for checking the Spark queries on the test tables."""

from oracle.queries import oracle_queries

__all__ = ["oracle_queries"]
