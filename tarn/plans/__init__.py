"""Loads and the registered queries."""

from __future__ import annotations


def all_queries():
    """Every registered query by name; importing the modules registers them."""
    from tarn.plans import change_queries, frame_queries, sink_queries, source_queries, table_queries  # noqa: F401
    from tarn.plans.registry import QUERIES

    return QUERIES
