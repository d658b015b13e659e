"""A registry of queries: a function of (spark, sf_dir), and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .views import with_views


class Queries:
    def __init__(self):
        self.functions: dict[str, Callable[..., DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, *views: str):
        """Decorator. ``sql`` stands behind the views that it names; None where SQL can't say it."""

        def put(f):
            self.functions[name] = f
            if sql is not None:
                self.sql[name] = with_views(sql, *views) if views else sql
            return f

        return put
