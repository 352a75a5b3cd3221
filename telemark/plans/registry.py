"""Collecting queries with their SQL twins."""

from __future__ import annotations


class Registry:
    def __init__(self):
        self.queries, self.oracles = {}, {}

    def query(self, name: str, sql: str | None = None):
        def add(function):
            self.queries[name] = function
            if sql is not None:
                self.oracles[name] = sql
            return function

        return add
