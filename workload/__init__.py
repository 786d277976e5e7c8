"""Queries over the driver's tables, each next to the SQL it must agree with."""

from workload import (  # noqa: F401  (each module registers its queries)
    cleaning,
    incremental,
    indicators,
    medallion,
    nesting,
    storage,
)
from workload.registry import oracles, queries

__all__ = ["oracles", "queries"]
