"""Registry of driver queries: a Spark function and its plain-SQL equivalent side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Test tables of one folder by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        found = self.__dict__[name] = load(self.spark, self.folder, name)
        return found


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with its SQL."""

    def register(f):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: f(Tables(configure(spark), folder))
        QUERIES[name].__doc__ = f.__doc__
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register
