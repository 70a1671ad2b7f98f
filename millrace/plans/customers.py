"""Customer mart: current, inactive customers under a hashed key, loaded incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.keys import surrogate_key
from millrace.operators.suite import RowCheck, TableCheck
from millrace.operators import quality
from millrace.plans.incremental import CurrentRows, current_rows, newer_than_any
from millrace.sinks import write_incremental
from millrace.sources.tables import DEFAULT_FORMAT

NAME = ["first_name", "last_name"]
STAMP = "last_update"


def current_customers(customers: DataFrame) -> DataFrame:
    return current_rows(customers, NAME, STAMP)


def customer_mart(customers: DataFrame, standing: DataFrame | None = None) -> DataFrame:
    """Rows to add to the mart; with a standing mart only those newer than its latest update."""
    return _mart_of(current_customers(customers), standing)


def _mart_of(current: DataFrame, standing: DataFrame | None) -> DataFrame:
    inactive = current.where(F.col("active") == 0).select(*NAME, "email", STAMP)
    rows = inactive if standing is None else newer_than_any(inactive, standing, [STAMP])
    return rows.select(surrogate_key(*NAME).alias("customer_sk"), *NAME, STAMP)


def kept_customers(path: str, buckets: int = 64, fmt: str = DEFAULT_FORMAT) -> CurrentRows:
    """Current customers that are kept up to date by merging changes into the buckets they touch."""
    return CurrentRows(path, tuple(NAME), STAMP, buckets, fmt)


def customer_mart_of_kept(kept: CurrentRows, changes: DataFrame, number: int) -> DataFrame:
    """Takes changed customers in and returns the mart of all customers; what has not changed is not joined again."""
    kept.merge(changes, number)
    current = kept.rows(changes.sparkSession, changes.schema)
    return _mart_of(changes.limit(0) if current is None else current, None)


def build_customer_mart(spark: SparkSession, customers: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return write_incremental(spark, path, lambda standing: customer_mart(customers, standing), fmt)


def customer_mart_checks(mart: DataFrame) -> list[RowCheck | TableCheck]:
    return [
        TableCheck("customer_sk is unique", quality.unique(mart, "customer_sk")),
        RowCheck("customer_sk is not null", mart, F.col("customer_sk").isNull()),
    ]
