"""The registered queries: what each runs on Spark, and the same result in plain SQL."""

from oreworks.catalog import bronze, gold, history, quality, silver, tables  # noqa: F401
from oreworks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
