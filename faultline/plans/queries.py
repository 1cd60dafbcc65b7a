"""All registered queries."""

from __future__ import annotations

from faultline.plans import (  # noqa: F401  (importing registers them)
    cleaning_queries,
    event_queries,
    geo_queries,
    layout_queries,
    learning_queries,
)
from faultline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
