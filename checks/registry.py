"""Registry of the checked queries."""

from __future__ import annotations

from collections.abc import Callable

from checks.oracle import with_views

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, views: tuple[str, ...] | str = (), sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` is the expected result over ``views``."""
    views = (views,) if isinstance(views, str) else views

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(views, sql) if views else sql
        return fn

    return add
