"""Queries of the training-data operators and their SQL, kept apart from the rest of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eddyline.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register `fn(spark, sf_dir)`; with `sql`, the DuckDB statement that must give the same rows."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
