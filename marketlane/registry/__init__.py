"""All named queries with the SQL that checks them."""

from marketlane.registry import (  # noqa: F401
    changes,
    expressions,
    products,
    relational,
    reports,
    storage,
)
from marketlane.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
