"""Named queries with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    survey: str
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, survey: str, sql: str | None = None):
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(fn, survey, sql)
        return fn

    return add
