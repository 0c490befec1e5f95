"""Registered queries over the star schema, each with its SQL counterpart."""

from wattloom.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates, alignment, filling, forecasts, indicators, market, projections, quality, sources, texts, windows,
)
from wattloom.catalog.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
