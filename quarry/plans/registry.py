"""Named queries, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        if key in _queries:
            raise ValueError(f"two queries are named {key}")
        _queries[key] = f
        if oracle:
            _oracles[key] = oracle
        return f

    return add


def _load() -> None:
    from quarry.plans import catalog_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
