"""The queries of the subpackage and their SQL oracles."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["bpe_queries", "mixing_queries", "quality_queries", "winnow_queries", "toxicity_queries", "langid_queries", "chat_queries", "url_queries", "ngram_queries", "suffix_queries",
            "whitening_queries", "periodic_queries", "simhash_queries"]


def queries():
    found = {}
    for name in _MODULES:
        found |= import_module(f"tessera.llm.{name}").QUERIES
    return found


def oracle_sql():
    found = {}
    for name in _MODULES:
        found |= getattr(import_module(f"tessera.llm.{name}"), "ORACLE", {})
    return found
