"""All checkable queries, by name."""

from trafficcast.registry import models, series, store, views  # noqa: F401  (they register)
from trafficcast.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
