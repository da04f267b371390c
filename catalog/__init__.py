"""Checked queries over the driver tables, each with its oracle where SQL can say it."""

import importlib

MODULES = ("sources", "selecting", "grouping", "analytics")


def load():
    """All queries and oracles by name."""
    from catalog.base import ORACLES, QUERIES
    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return dict(QUERIES), dict(ORACLES)
