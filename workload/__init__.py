"""Queries over the given tables, one per operator."""

from __future__ import annotations


def all_queries():
    """Import the query modules and return what they registered."""
    from workload import entity_queries, ingest_queries, report_queries  # noqa: F401
    from workload.registry import QUERIES

    return QUERIES
