"""Registered queries. Importing the modules below registers them."""

from logilake.catalog import expressions, joined, network, states, storage, tables, upkeep
from logilake.catalog.registry import ORACLE, QUERIES

__all__ = ["all_queries", "all_sql", "expressions", "joined", "network", "states", "storage", "tables", "upkeep"]


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(ORACLE)
