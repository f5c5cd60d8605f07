"""DuckDB statements that compute the registered queries a second time, from the same tables."""

from oracle.statements import statements

__all__ = ["statements"]
