"""Named queries: a Spark function over the tables and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from .views import Tables, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(sql, views)
        return fn
    return add


def callables() -> dict:
    return {name: (lambda spark, path, fn=fn: fn(Tables(spark, path))) for name, fn in QUERIES.items()}
