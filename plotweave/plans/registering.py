"""Registers a query with the SQL that must give the same rows."""

from __future__ import annotations

from .views import twin

QUERIES: dict = {}
TWINS: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            TWINS[f.__name__] = twin(sql, *views)
        return f

    return keep
