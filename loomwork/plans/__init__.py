"""Composed queries and the SQL each one is checked against."""

from loomwork.plans.registry import oracles, queries

__all__ = ["oracles", "queries"]
