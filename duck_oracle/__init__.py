"""DuckDB oracle SQL for every registered query that SQL can express."""

from duck_oracle.extra import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
