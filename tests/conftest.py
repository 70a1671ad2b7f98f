from __future__ import annotations

from collections import Counter

import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        app="millrace-tests",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(schema, row, ...)`` makes a DataFrame."""

    def make(schema: str, *data):
        return spark.createDataFrame([d if isinstance(d, tuple) else (d,) for d in data], schema)

    return make


def bag(df) -> Counter:
    """The rows of a DataFrame, counted."""
    return Counter(tuple(r) for r in df.collect())


def plan_of(df, executed: bool = False) -> str:
    """Text of the physical plan; after execution the one that adaptive execution settled on."""
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
