"""Every query this repository registers, by name."""

from catalog.queries import QUERIES

__all__ = ["QUERIES"]
