"""Merging small files only."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators.relations import differences, differences_by_bucket
from millrace.plans.maintenance import compact_small, live_files, read_live, stale_files
from millrace.sources.tables import read_table
from millrace.workload import REGISTRY
from tests.conftest import bag, plan_of


def data_files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_large_files_keep_name_and_time(spark, tmp_path, by):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = spark.range(40_000).select("id", (F.col("id") % 3).cast("string").alias("g"), F.hash("id").alias("v"))
    rows.where("id >= 4000").coalesce(1).write.partitionBy(*by).parquet(old)
    rows.where("id < 4000").repartition(8).write.mode("append").partitionBy(*by).parquet(old)
    before = data_files(old)
    largest = max(s.st_size for s in before.values())
    made = compact_small(spark, old, new, by, target_bytes=largest, small_bytes=largest // 2, exact_check=True)
    assert bag(made) == bag(read_table(spark, old)) and made.columns == read_table(spark, old).columns
    assert {p: (s.st_mtime, s.st_size) for p, s in data_files(old).items()} == {p: (s.st_mtime, s.st_size) for p, s in before.items()}
    live = {r.path.removeprefix("file://").removeprefix("file:") for r in live_files(spark, new).collect()}
    large = {p for p, s in before.items() if s.st_size >= largest // 2}
    assert large and large < live and live - large == set(data_files(new)) - {p for p in data_files(new) if "_live" in p}
    assert len(live) == 2 * max(1, 3 * len(by))  # of each folder one large file and one merged one
    later = F.timestamp_add("day", F.lit(8), F.current_timestamp())
    stale = {r.path for r in stale_files(spark, old, [p for p in live if p in before], now=later).collect()}
    assert len(stale) == len(before) - len(large)


def test_nothing_to_merge_and_bins_of_the_target_size(spark, tmp_path):
    old = str(tmp_path / "old")
    spark.range(9_000).repartition(9).write.parquet(old)
    size = max(s.st_size for s in data_files(old).values())
    assert bag(compact_small(spark, old, str(tmp_path / "a"), small_bytes=1)) == bag(spark.range(9_000))
    assert live_files(spark, str(tmp_path / "a")).count() == 9
    compact_small(spark, old, str(tmp_path / "b"), target_bytes=3 * size, small_bytes=2 * size)
    assert live_files(spark, str(tmp_path / "b")).count() in (3, 4)
    schema = spark.range(0).schema
    assert bag(read_live(spark, str(tmp_path / "b"), schema)) == bag(spark.range(9_000))


def test_equal_tables_send_no_rows(spark):
    a = spark.range(5_000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 0.5).alias("x"), F.array("id").alias("y"))
    b = a.repartition(3)
    found = differences_by_bucket(a, b, multiset=True)
    assert found.isEmpty() and "LocalTableScan" in plan_of(found, executed=True)
    changed = b.where("id <> 77").unionAll(b.where("id = 5"))
    assert bag(differences_by_bucket(a, changed, multiset=True).select("which_diff", "id")) == Counter({("a_minus_b", 77): 1, ("b_minus_a", 5): 1})
    assert bag(differences_by_bucket(a, changed).select("which_diff", "id")) == Counter({("a_minus_b", 77): 1})


def test_values_of_several_spellings_are_compared_in_full(spark):
    a = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "k string, v double")
    b = spark.createDataFrame([("A", -0.0), ("b", 1.0)], "k string, v double")
    assert bag(differences_by_bucket(a.select("v"), b.select("v"))) == bag(differences(a.select("v"), b.select("v"))) == Counter()
    a, b = (d.withColumn("k", F.col("k").cast("string collate UTF8_LCASE")) for d in (a, b))
    assert differences_by_bucket(a, b).isEmpty()


def test_files_of_the_selective_query_do_not_grow_with_the_table(spark, tmp_path):
    line = spark.range(240_000).select(
        F.xxhash64("id").alias("l_orderkey"), F.hash("id").alias("l_partkey"), F.lit(1).alias("l_linenumber"), F.rand(1).alias("l_quantity"),
        F.when(F.col("id") % 2 > 0, "N").when(F.col("id") % 4 > 0, "A").otherwise("R").alias("l_returnflag"))
    line.repartition(16).write.parquet(str(tmp_path / "lineitem.parquet"))
    line = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        found = REGISTRY["compact_selective"].plan(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {f.removeprefix("file://") for f in found.inputFiles()}
    assert max(os.stat(f).st_size for f in files) < 600_000 and len(files) > 9  # "N" has 90,000 old rows of 2 MB
    assert bag(found) == bag(line)
