"""Every operator as a query over the given tables, with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Queries of one area, in the order they were added."""

    queries: dict[str, Query]
    oracles: dict[str, str]

    def add(self, name: str, oracle: str | None = None):
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return register


def all_queries() -> tuple[dict[str, Query], dict[str, str]]:
    from corpusloom.queries import (
        dialogue,
        labels,
        model_tables,
        packing,
        render,
        scans,
        selection,
        tokens,
        user_functions,
    )

    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for module in (
        scans,
        selection,
        render,
        tokens,
        packing,
        labels,
        dialogue,
        model_tables,
        user_functions,
    ):
        queries.update(module.R.queries)
        oracles.update(module.R.oracles)
    return queries, oracles
