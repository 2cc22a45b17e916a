"""Registered queries over the given tables, each with its check in plain SQL."""

from importlib import import_module

from laurel.catalog.registry import QUERIES, SQL

MODULES = ["cleaning", "extraction", "counting", "timing", "linking", "scoring"]


def load():
    """Import all query modules; returns ``(queries, sql)`` by name."""
    for module in MODULES:
        import_module(f"laurel.catalog.{module}")
    return QUERIES, SQL
