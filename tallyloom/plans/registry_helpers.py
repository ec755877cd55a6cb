"""How a module of queries keeps its book."""

from __future__ import annotations

from collections.abc import Callable


def book() -> tuple[dict, dict, Callable]:
    """``QUERIES``, ``SQL`` and the decorator that fills them: the key is the function's name, its first letter a capital."""
    queries: dict = {}
    sql: dict = {}

    def query(text: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            name = f.__name__[0].upper() + f.__name__[1:]
            queries[name] = f
            if text is not None:
                sql[name] = text
            return f

        return add

    return queries, sql, query
