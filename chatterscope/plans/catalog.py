"""Registering a query together with its SQL counterpart."""

from __future__ import annotations


class Catalog:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register a query under its function name."""

        def register(function):
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return register
