"""All queries of the library by name, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are called {name}")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return put


def _loaded() -> None:
    from . import bin_queries, contact_queries, fit_queries, graph_queries, job_queries, matrix_queries, more_queries, scalar_queries, source_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _loaded()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _loaded()
    return dict(_SQL)


def entry(spark: SparkSession) -> DataFrame:
    """Top contacts after scaling, from pairing to the percentile cut."""
    return queries()["flagship_scaled_contacts"](spark, "/root/testdata/sf0.001")
