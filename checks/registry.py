"""Registration of queries and oracles."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def r6(*cols: str, digits: int = 6) -> str:
    """round(c, 6) as c for each column (or 'expr as name')."""
    out = []
    for col in cols:
        expr, _, name = col.partition(" as ")
        out.append(f"round({expr},{digits}) as {name or expr}")
    return ", ".join(out)
