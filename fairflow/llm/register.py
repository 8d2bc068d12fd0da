"""The registry of this subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return register
