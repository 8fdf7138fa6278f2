"""Registered queries over the driver tables, each with its DuckDB twin."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for part in ("series", "pairs", "intervals", "records", "logs", "waves", "surface"):
        importlib.import_module(f"{__name__}.{part}")
