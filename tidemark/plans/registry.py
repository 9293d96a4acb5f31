"""The list that queries enter themselves in, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Enter a function of (spark, sf_dir) under a name."""

    def enter(function):
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return enter
