"""Registered queries: each a callable over a folder of test tables, most with the SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None, with_: tuple[str, ...] = ()) -> Callable:
    """Register a builder ``f(tables) -> DataFrame`` under its own name, with its oracle."""

    def add(builder: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = builder.__name__
        QUERIES[name] = lambda spark, sf_dir: builder(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = (f"WITH {', '.join(with_)} " if with_ else "") + sql
        return builder

    return add


def rounded(x: str, digits: int) -> str:
    """The rounding rule of the library as SQL."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"
