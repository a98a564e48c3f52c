"""All queries of the engine, by name."""

from scriptorium.plans import inventory_queries, reference_queries  # noqa: F401  register
from scriptorium.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
