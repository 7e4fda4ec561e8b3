"""Queries over the driver's tables, one or more per operator."""

from cellshift.catalog import (  # noqa: F401
    checks,
    comparisons,
    composites,
    experiments,
    lineage,
    profiles,
    scalars,
    storage,
)
from cellshift.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
