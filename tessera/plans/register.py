"""How a module lists its queries and the SQL that tells their results."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict[str, str], Callable]:
    """(queries, sql, decorator): the decorator takes the SQL of the query below it, or none."""
    queries: dict = {}
    sqls: dict[str, str] = {}

    def query(sql: str | None = None):
        def register(f):
            queries[f.__name__] = f
            if sql:
                sqls[f.__name__] = sql
            return f

        return register

    return queries, sqls, query
