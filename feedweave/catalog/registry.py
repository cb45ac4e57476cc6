"""Registry of named queries over the test tables, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from ..sources.readers import read_table


class Tables:
    """The tables of one data folder, as attributes, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, f"{self.folder}/{name}.parquet", "parquet")
        setattr(self, name, table)
        return table

    def values(self, columns: str, *rows: str) -> DataFrame:
        """A few literal lookup rows."""
        return self.spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS v({columns})")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name`` with its SQL counterpart."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
