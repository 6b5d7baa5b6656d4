"""A set of registered queries."""

from __future__ import annotations


class Book:
    """Decorator factory: ``@book(sql)`` files a query and its SQL under the function's name."""

    def __init__(self):
        self.queries = {}
        self.sql = {}

    def __call__(self, sql: str | None = None):
        def add(fn):
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return add
