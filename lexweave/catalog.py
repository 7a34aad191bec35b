"""Registry of the named queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with its oracle if SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


from lexweave.plans import entry_queries, graph_queries, lexicon_queries, predicate_queries, repair_queries, report_queries, text_queries  # noqa: E402, F401
