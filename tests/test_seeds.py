"""CSV with line breaks inside quotes, read by several tasks a file."""

from __future__ import annotations

import csv
import os
import random
from collections import Counter

import pytest

from millrace.sources.seeds import read_large_seed
from millrace.sources.tables import read_seed
from millrace.workload import REGISTRY
from tests.conftest import bag

SCHEMA = "id bigint, a string, b string"


def written(path, rows, end="\r\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator=end, quoting=quoting)
        out.writerow(["id", "a", "b"])
        out.writerows(rows)


def texts(seed, n):
    draw = random.Random(seed)
    words = ['say "x"', "a,b", "line\nbreak", "\n\n", "plain", "", '"', "end\n", "über 日", "tab\tx", '",\n"', " pad "]
    return [(i, "".join(draw.choices(words, k=draw.randrange(6))), draw.choice(words)) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [16, 97, 1000])
def test_records_are_whole_wherever_files_are_split(spark, tmp_path, split, end):
    for file in range(2):
        written(tmp_path / f"{file}.csv", texts(file, 60), end)
    expected = Counter((i, a or None, b or None) for file in range(2) for i, a, b in texts(file, 60))
    found = read_large_seed(spark, str(tmp_path), SCHEMA, split_bytes=split)
    assert bag(found) == expected == bag(read_seed(spark, str(tmp_path), SCHEMA))


def test_more_tasks_than_files_and_a_record_over_many_splits(spark, tmp_path):
    long = "word, \"quoted\"\n" * 2_000
    written(tmp_path / "one.csv", [(1, long, "x"), (2, "y", long), (3, "z", None)], quoting=csv.QUOTE_ALL)
    path, size = str(tmp_path), os.path.getsize(tmp_path / "one.csv")
    found = read_large_seed(spark, path, SCHEMA, split_bytes=4096)
    assert size > 10 * 4096 and bag(found) == Counter({(1, long, "x"): 1, (2, "y", long): 1, (3, "z", None): 1})


def test_files_without_records(spark, tmp_path):
    written(tmp_path / "a.csv", [])
    (tmp_path / "b.csv").write_text("")
    assert read_large_seed(spark, str(tmp_path), SCHEMA).isEmpty()


def test_the_seed_of_a_larger_table_has_more_files(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, n_chars bigint"
    docs = [(i, t, "en" if i % 3 else None, len(t)) for i, t, _ in texts(5, 200)]
    spark.createDataFrame(docs, schema).repartition(16).write.parquet(str(tmp_path / "documents.parquet"))
    tasks = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    found = REGISTRY["csv_seed"].plan(spark, str(tmp_path))
    assert len(found.inputFiles()) == tasks > 2
    assert bag(found) == Counter((i, t or None, lang, n) for i, t, lang, n in docs)
