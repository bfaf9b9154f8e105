"""Registry of queries: a name, the Spark function, the equivalent SQL (if there is one) and the operators it shows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from layerloom.plans.oracle import relation, sql as with_relations

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    shows: str


ENTRIES: dict[str, Entry] = {}


def query(shows: str, sql: str | None = None, name: str | None = None):
    """Register a query. ``sql`` may use the relations of the oracle; they are put in front of it."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        if key in ENTRIES:
            raise ValueError(f"two queries are called {key}")
        ENTRIES[key] = Entry(run, None if sql is None else with_relations(sql), shows)
        return run

    return register


def model(shows: str, name: str, columns: str = "*"):
    """Register a query whose SQL is the oracle relation of the same name."""

    def register(run: Query) -> Query:
        ENTRIES[name] = Entry(run, relation(name, columns), shows)
        return run

    return register
