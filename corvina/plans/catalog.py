"""Registry of the engine's named queries over the shared test tables.

Each entry of ``QUERIES`` takes (spark, sf_dir) and returns a DataFrame; the entry of the
same name in ``ORACLES`` is SQL that returns the same rows and column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared Parquet tables, by a path that only Spark needs to reach."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can express it."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return put
