"""Names, plans and equivalent SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import Source

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


REGISTRY: dict[str, Query] = {}


class Tables:
    """The test tables of one folder as attributes: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._source = Source(spark, folder)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._source.table(name)


def query(name: str, sql: str | None = None):
    """Register a function of the test tables under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(lambda spark, folder: build(Tables(spark, folder)), sql)
        return build

    return register
