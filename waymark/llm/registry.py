"""Named queries of the training-data operators with their SQL counterpart, where SQL can express one."""

from __future__ import annotations

import importlib

_MODULES = ("decontaminate", "embedding_graph", "fill_middle", "language_id", "line_dedup", "mixing", "near_dedup", "pii", "prefix_trie", "quality_rules", "suffix_tree",
            "toxicity", "token_counts")
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"waymark.llm.{module}")


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_SQL)
