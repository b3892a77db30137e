"""Queries over the given tables, one or more for each operator."""

from importlib import import_module

MODULES = ["shape", "aggregates", "joins", "storage", "quality", "streams", "releases", "layouts"]


def all_queries():
    from tidemill.plans.registry import QUERIES

    for module in MODULES:
        import_module(f"tidemill.plans.{module}")
    return dict(QUERIES)
