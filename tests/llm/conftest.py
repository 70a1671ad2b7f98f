from __future__ import annotations

import pytest

from millrace.llm.workload import importable

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


#: Texts that every operator must take.
ODD_TEXTS = [None, "", " ", "\n\n", "a", "…—", "one two three", "x" * 5_000, "word " * 40_000, "Ünï cödé 한국어 русский 😀",
             "a\x00b c", "same text again", "same text again"]


@pytest.fixture
def odd(spark):
    """Odd texts with null and repeated ids and columns named like results of operators."""
    rows = [(None if i == 4 else i if i < 12 else 11, t, "mine", -1.0, [7]) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, score double, token_ids array<int>")
