"""Named queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a builder under a name, with the SQL that gives the same rows where SQL can."""

    def add(builder: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query registered twice: {name}")
        _QUERIES[name] = builder
        if oracle is not None:
            _ORACLES[name] = oracle
        return builder

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
