"""Registered queries over the driver tables and their DuckDB twins."""

from __future__ import annotations


def load_all() -> None:
    """Import every query module so that its queries register."""
    from . import model_queries, panel_ops_queries, panel_queries, profile_queries, scalar_queries  # noqa: F401


def queries():
    from .registry import QUERIES

    load_all()
    return dict(QUERIES)


def oracle_sql():
    from .registry import ORACLE

    load_all()
    return dict(ORACLE)
