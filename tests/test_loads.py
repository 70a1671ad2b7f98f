"""Numbered loads whose marks and summaries are kept beside the table."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans.customers import customer_mart_of_kept, kept_customers
from millrace.plans.incremental import CurrentRows, Loads, current_rows, newer_than_target
from millrace.plans.kept import Kept, marks, summaries
from millrace.plans.weather import KEYS, kept_loads, load_stream_of_records, publish_kept, summarise
from millrace.sources.feed import WEATHER
from millrace.streaming.ingest import append_stream, load_stream, open_files, without_repeats
from tests.conftest import bag

FEED = "k string, t string, v double"


def loads_in(spark, folder, **options):
    return Loads(f"{folder}/table", marks(spark, f"{folder}/marks", ["k"]), "t", ("k",), new_keys="keep", averages=("v",),
                 summary=summaries(spark, f"{folder}/summary", ["k"], ["v"], "t"), **options)


def feed(seed: int, n: int = 60):
    draw = random.Random(seed)
    return [(draw.choice(["a", "b", "c", None]), draw.choice([None, f"2024-01-{draw.randint(1, 28):02}"]),
             draw.choice([None, draw.randint(0, 9) / 4])) for _ in range(n)]


@pytest.mark.parametrize("new_keys,fold_after", [("drop", 1), ("keep", 2)])
def test_loads_equal_loading_from_the_whole_table(spark, tmp_path, new_keys, fold_after):
    """Every load against marks found in the whole table so far; loads 1 and 3 are repeated."""
    loads = loads_in(spark, tmp_path, fold_after=fold_after)
    table = spark.createDataFrame([], FEED)
    for number in range(4):
        rows = spark.createDataFrame(feed(number), FEED)
        how = "keep" if number == 0 else new_keys
        fresh = rows if number == 0 else newer_than_target(rows, table, ["k"], "t", how)
        table = spark.createDataFrame([tuple(r) for r in table.unionAll(fresh).collect()], FEED)
        for _ in range(2 if number in (1, 3) else 1):
            loads.load(rows, number, how)
        assert bag(loads.table(spark).select("k", "t", "v")) == bag(table)
        assert bag(loads.summarised()) == bag(summarise(table, ["k"], ["v"], "t"))


def test_a_load_reads_no_rows_of_the_table(spark, tmp_path):
    loads = loads_in(spark, tmp_path)
    loads.load(spark.createDataFrame(feed(1), FEED), 0)
    known = loads.marks.current(1, only=spark.createDataFrame(feed(2), FEED))
    files = known.inputFiles()
    assert files and all("/marks/" in f for f in files)


def test_a_batch_that_fails_half_way_comes_again(spark, tmp_path):
    """The first try writes its rows and fails before the marks; the second one leaves no row twice."""
    source, loads = str(tmp_path / "source"), loads_in(spark, tmp_path)
    spark.createDataFrame(feed(3), FEED).write.parquet(source)
    tries = []

    def load(batch, number):
        tries.append(number)
        loads.load(batch, number)
        if len(tries) == 1:
            raise RuntimeError("lost")

    def run():
        load_stream(open_files(spark, source, spark.createDataFrame([], FEED).schema), load, str(tmp_path / "checkpoint"),
                    until_caught_up=True).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert tries == [0, 0]
    assert bag(loads.table(spark).select("k", "t", "v")) == Counter(feed(3))


def test_folds_cover_every_load_once(spark, tmp_path):
    kept = Kept(spark, str(tmp_path / "kept"), ("k",), {"n": F.sum})
    one = spark.createDataFrame([("a", 1), (None, 1)], "k string, n long")
    assert kept.current() is None and kept.entries() == []
    for number in range(-1, 7):
        kept.put(number, one)
        kept.fold(number, 3)
        assert bag(kept.current()) == Counter({("a", number + 2): 1, (None, number + 2): 1})
        assert len(kept.entries()) <= 3
    assert bag(kept.current(before=4)) == Counter({("a", 5): 1, (None, 5): 1})
    assert bag(kept.current(only=one.where("k is null"))) == Counter({(None, 8): 1})
    kept.put(5, one)  # repeated while later loads exist
    assert bag(kept.current(before=6)) == Counter({("a", 7): 1, (None, 7): 1})


def test_a_load_without_rows(spark, tmp_path):
    loads = loads_in(spark, tmp_path)
    none = spark.createDataFrame([], FEED)
    assert loads.load(spark.createDataFrame(feed(1), FEED), 0, "drop").isEmpty()  # no key is known yet
    loads.load(spark.createDataFrame(feed(1), FEED), 1)
    assert loads.load(none, 2).isEmpty()
    assert loads.table(spark).count() == len(feed(1))


def test_weather_records_in_runs(spark, tmp_path):
    source, data, state = (str(tmp_path / n) for n in ("source", "data", "state"))

    def record(city, country, temperature, stamp):
        return ({"name": city, "region": "r", "country": country}, {"temp_c": temperature, "wind_kph": 1.0, "last_updated": stamp})

    def arrive(*rows):
        location = "location struct<name:string,region:string,country:string>"
        df = spark.createDataFrame(list(rows), location + ", current struct<temp_c:double,wind_kph:double,last_updated:string>")
        df.coalesce(1).write.mode("append").parquet(source)

    loads = kept_loads(spark, data, state, new_keys="keep")
    arrive(record("Gent", "Belgium", 3.0, "2024-01-01 10:00"), record("Oslo", "Norway", 1.0, "2024-01-01 10:00"))
    load_stream_of_records(spark, source, loads, f"{state}/checkpoint", WEATHER).awaitTermination()
    arrive(record("Gent", "Belgium", 9.0, "2024-01-01 10:00"), record("Gent", "Belgium", 5.0, "2024-01-01 11:00"))
    load_stream_of_records(spark, source, loads, f"{state}/checkpoint", WEATHER).awaitTermination()
    found = publish_kept(loads)
    assert found.columns == [*KEYS, "temperature", "windspeed", "number_of_rows", "modifiedon"]
    assert bag(found) == Counter({("Belgium", "r", "Gent", 4.0, 1.0, 2, "2024-01-01 11:00"): 1})


def test_merged_current_rows_equal_those_of_all_rows(spark, tmp_path):
    """Five deliveries, two of them repeated; buckets without new rows stay as they are."""
    kept = CurrentRows(str(tmp_path / "current"), ("k", "j"), "t", buckets=4)
    every = []
    for number in range(5):
        draw = random.Random(number)
        rows = [(draw.choice(["a", "b", "c", None]), draw.randrange(3), draw.choice([None, *range(9)]), draw.randrange(3)) for _ in range(12)]
        if number == 4:
            rows = [("a", 1, 99, 0), ("a", 1, 99, 0), ("a", 1, 98, 0)]
        every += rows
        delta = spark.createDataFrame(rows, "k string, j int, t int, v int")
        before = kept.versions(spark, number)
        for _ in range(2 if number in (1, 3) else 1):
            touched = kept.merge(delta, number)
        after = kept.versions(spark)
        assert all(after[b] == m for b, m in before.items() if b not in touched)
        whole = current_rows(spark.createDataFrame(every, delta.schema), ["k", "j"], "t")
        assert bag(kept.rows(spark, delta.schema)) == bag(whole)
    assert len(touched) == 1 and len(after) > 1
    read = kept.rows(spark, delta.schema, only=touched).inputFiles()
    assert read and all(f"__bucket={touched[0]}/" in f for f in read)


def test_a_delivery_without_customers(spark, tmp_path):
    schema = "first_name string, last_name string, email string, last_update timestamp_ntz, active int"
    kept = kept_customers(str(tmp_path / "kept"))
    mart = customer_mart_of_kept(kept, spark.createDataFrame([], schema), 0)
    assert mart.columns == ["customer_sk", "first_name", "last_name", "last_update"] and mart.isEmpty()
    one = spark.createDataFrame([("An", "Bo", "an@x", datetime(2024, 1, 1), 0)], schema)
    assert customer_mart_of_kept(kept, one, 1).count() == 1


def test_repeated_messages_are_dropped_across_runs(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))
    schema = "key binary, timestamp timestamp, v int"
    stamp = datetime(2024, 1, 1)
    first = [(bytearray(b"%d" % i), stamp + timedelta(hours=i), i) for i in range(10)]
    second = [(bytearray(b"%d" % i), stamp + timedelta(hours=i), i) for i in range(5, 15)]
    for rows in (first + first, second + first[7:]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = open_files(spark, source, spark.createDataFrame([], schema).schema)
        append_stream(without_repeats(stream, ["key"], "timestamp", "1 day"), path, checkpoint, until_caught_up=True).awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == list(range(15))
