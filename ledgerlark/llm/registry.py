"""Registration of the subpackage's queries and of the SQL they are checked against."""

from __future__ import annotations

from ledgerlark.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name; without ``sql`` it is tested against brute force."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add
