"""Registered queries: every operator and question over the given tables."""

from tidemart.catalog import (  # noqa: F401
    aggregates,
    business,
    cleaning,
    history,
    io,
    joins,
    models,
    quality,
    scalars,
    stages,
    streams,
    windows,
)
from tidemart.catalog.registry import QUERIES, ask, run

__all__ = ["QUERIES", "ask", "run"]
