"""The registry of queries: each is a function of the derived tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrasheaf.plans.standins import Tables, with_standins
from terrasheaf.runtime import ship

_queries: dict[str, Callable[[Tables], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _queries[f.__name__] = f
        if sql:
            _oracles[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def on(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(Tables(spark, sf_dir))

        return on

    return {name: run(f) for name, f in _queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_standins(sql) for name, sql in _oracles.items()}


def uuid_sql(namespace: str, name: str, columns: str, rows: str, alias: str) -> str:
    """``columns`` of ``rows`` and the version 5 UUID of ``name``."""
    digest = f"sha1(unhex('{namespace.replace('-', '')}') || encode({name}))"
    variant = "substr('89ab', CAST(('0x' || d[17:17]) AS INT) % 4 + 1, 1)"
    return (
        f"SELECT {columns}, concat(d[1:8], '-', d[9:12], '-5', d[14:16], '-', {variant}, d[18:20], '-', d[21:32]) AS {alias} FROM (SELECT *, {digest} AS d "
        f"FROM {rows})"
    )
