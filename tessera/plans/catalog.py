"""All registered queries and their SQL oracles."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["monitoring", "shaping", "statistics", "registry", "learning", "attribution", "streams", "io"]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = import_module(f"tessera.plans.{name}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
