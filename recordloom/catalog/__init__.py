"""Registered queries over the benchmark tables, each with its SQL counterpart where SQL can say it."""

from recordloom.catalog import (  # noqa: F401
    chains,
    ingestion,
    jobs,
    outcomes,
    planning,
    records,
    retrieval,
    sources,
)
from recordloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
