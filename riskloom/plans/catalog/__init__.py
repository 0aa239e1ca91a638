"""All queries with their oracle SQL."""

from riskloom.plans.catalog import boosted, evaluation, incremental, learning, preparation, profiling, sampling  # noqa: F401
from riskloom.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
