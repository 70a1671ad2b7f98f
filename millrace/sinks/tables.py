"""Batch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from millrace.sources.tables import DEFAULT_FORMAT, read_table, read_table_if_exists, refresh


def balanced(df: DataFrame, *partition_columns: str) -> DataFrame:
    """Rows of one partition value together in files of even size.

    Adaptive execution splits a value that is too large for one task and merges small ones, so a
    hot city neither lands in a single task nor do all tasks write a sliver of every city.
    """
    return df.hint("rebalance", *partition_columns)


def append_partitioned(df: DataFrame, path: str, partition_columns: list[str], fmt: str = DEFAULT_FORMAT) -> None:
    writer = balanced(df, *partition_columns).write.format(fmt).mode("append")
    writer.partitionBy(*partition_columns).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace a lake table. ``df`` must not read from ``path``."""
    df.write.format(fmt).mode("overwrite").save(path)


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
               driver: str | None = None, connections: int | None = None, keep_definition: bool = False) -> None:
    """Replace a database table.

    ``connections`` bounds how many tasks write at once. Every task commits its own rows, so point
    ``table`` at a table readers do not use yet if they must never see part of the result.
    """
    given = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
             "numPartitions": connections, "truncate": str(keep_definition).lower()}
    options = {name: str(value) for name, value in given.items() if value is not None}
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, path: str | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Catalog table, at ``path`` if given, else in the warehouse folder."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_incremental(spark, path: str, model: Callable[[DataFrame | None], DataFrame],
                      fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Build a model for the first time, or append what is new to it.

    ``model`` gets the table as it stands (None before the first run) and returns the rows to add.
    The files of the standing table are listed before the append begins, so the model never sees
    rows of its own run. No key is enforced: a row returned twice is stored twice.
    """
    standing = read_table_if_exists(spark, path, fmt)
    rows = model(standing)
    rows.write.format(fmt).mode("overwrite" if standing is None else "append").save(path)
    refresh(spark, path)
    return read_table(spark, path, fmt)
