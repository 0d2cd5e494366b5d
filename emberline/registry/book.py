"""Collects the named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    survey: str
    query: Query
    sql: str | None


BOOK: dict[str, Entry] = {}


def register(name: str, survey: str, query: Query, sql: str | None = None) -> None:
    """``survey`` names the inventory rows that the query covers; without ``sql`` only rows are checked."""
    if name in BOOK:
        raise ValueError(f"query registered twice: {name}")
    BOOK[name] = Entry(name, survey, query, sql)
