from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans import maintenance, weather
from millrace.plans.customers import build_customer_mart, current_customers, customer_mart, customer_mart_checks
from millrace.literals import constants
from millrace.plans.incremental import current_rows, newer_than_any, newer_than_target
from millrace.operators.suite import run_checks
from millrace.sinks import append_partitioned, as_table, as_view, overwrite, write_incremental, write_jdbc
from millrace.sources.feed import ENVELOPE, WEATHER
from millrace.sources.tables import read_table
from millrace.streaming.ingest import ingest, open_files, open_topic
from tests.conftest import bag

FEED = "k string, t string, v int"


@pytest.fixture
def staged(rows):
    return rows(FEED, ("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("a", "2024-01-03", 2), ("b", "2024-01-02", 3),
                ("new", "2024-01-01", 4), (None, "2024-01-09", 5), ("a", None, 6))


@pytest.fixture
def target(rows):
    return rows(FEED, ("a", "2024-01-02", 0), ("a", "2024-01-01", 1), ("b", "2024-01-02", 0), (None, "2024-01-05", 0))


def test_only_newer_rows_of_known_keys(staged, target):
    found = newer_than_target(staged, target, ["k"], "t")
    assert found.columns == ["k", "t", "v"]
    assert bag(found) == Counter({("a", "2024-01-03", 2): 2})
    assert newer_than_target(staged, target.limit(0), ["k"], "t").isEmpty()
    with pytest.raises(ValueError, match="keep"):  # a table could never start
        newer_than_target(staged, None, ["k"], "t")


def test_new_keys_can_be_kept(staged, target):
    found = newer_than_target(staged, target, ["k"], "t", new_keys="keep")
    assert bag(found) == Counter({("a", "2024-01-03", 2): 2, ("new", "2024-01-01", 4): 1, (None, "2024-01-09", 5): 1})
    assert bag(newer_than_target(staged, None, ["k"], "t", new_keys="keep")) == bag(staged)
    with pytest.raises(ValueError):
        newer_than_target(staged, target, ["k"], "t", new_keys="maybe")


@pytest.mark.parametrize("new_keys", ["drop", "keep"])
def test_loading_twice_adds_nothing(staged, target, new_keys):
    stamped = staged.where("t is not null")
    loaded = target.unionAll(newer_than_target(stamped, target, ["k"], "t", new_keys))
    assert newer_than_target(stamped, loaded, ["k"], "t", new_keys).isEmpty()


def test_stamps_can_be_compared_as_times(rows):
    staged = rows(FEED, ("a", "2024-1-9", 1), ("a", "2024-1-10", 2), ("a", "soon", 3))
    target = rows(FEED, ("a", "2024-1-9", 0), ("a", "later", 0))
    for new_keys in ("drop", "keep"):
        assert newer_than_target(staged, target, ["k"], "t", new_keys).count() == 1
        found = newer_than_target(staged, target, ["k"], "t", new_keys, compare_as="timestamp")
        assert bag(found) == Counter([("a", "2024-1-10", 2)])


def test_constants_keep_type_and_value(spark):
    row = spark.sql("""select timestamp'2024-10-27 00:30:00.123456' as a, timestamp_ntz'2024-10-27 02:30:00.5' as b,
                              date'2024-02-29' as c, 0.1D as d, 12.30BD as e, 'x' as f, cast(null as int) as g""")
    found = spark.range(1).select([c.alias(n) for n, c in constants(row).items()])
    assert found.collect() == row.collect() and found.dtypes == row.dtypes


def test_newer_than_any_field(rows):
    target = rows("a timestamp, b timestamp", (datetime(2024, 1, 5), None), (None, datetime(2024, 1, 2)))
    df = rows("a timestamp, b timestamp, id int", (datetime(2024, 1, 6), datetime(2024, 1, 1), 1),
              (datetime(2024, 1, 5), datetime(2024, 1, 2), 2), (None, datetime(2024, 1, 3), 3), (None, None, 4))
    assert bag(newer_than_any(df, target, ["a", "b"]).select("id")) == Counter([(1,), (3,)])
    assert bag(newer_than_any(df, target, "b").select("id")) == Counter([(3,)])
    assert newer_than_any(df, target.limit(0), ["a", "b"]).isEmpty()
    assert newer_than_any(df, target.select("a", F.lit(None).cast("timestamp").alias("b")), "b").count() == 3


def test_current_rows(rows):
    df = rows("k string, l string, t int, v int", ("a", "x", 1, 1), ("a", "x", 3, 2), ("a", "x", 3, 3), ("a", None, 9, 4),
              ("b", "y", None, 5), ("c", "z", None, 6), ("c", "z", 0, 7))
    assert bag(current_rows(df, ["k", "l"], "t").select("v")) == Counter([(2,), (3,), (7,)])


CUSTOMER = "first_name string, last_name string, email string, last_update timestamp, active int"
JANUARY, MARCH = datetime(2024, 1, 1), datetime(2024, 3, 1)


def test_customer_mart(spark, rows, tmp_path):
    first = rows(CUSTOMER, ("An", "Bo", "old@x", datetime(2023, 1, 1), 0), ("An", "Bo", "an@x", JANUARY, 0),
                 ("Cy", "Du", "cy@x", JANUARY, 1), (None, "No", "no@x", JANUARY, 0))
    assert current_customers(first).count() == 2
    path = f"{tmp_path}/mart"
    mart = build_customer_mart(spark, first, path)
    assert mart.columns == ["customer_sk", "first_name", "last_name", "last_update"]
    assert bag(mart.select("first_name")) == Counter([("An",)])
    second = first.unionAll(rows(CUSTOMER, ("Cy", "Du", "cy@x", MARCH, 0), ("Ed", "Fa", "ed@x", datetime(2023, 5, 5), 0)))
    for _ in range(2):
        mart = build_customer_mart(spark, second, path)
        assert bag(mart.select("first_name", "last_update")) == Counter([("An", JANUARY), ("Cy", MARCH)])
    assert bag(run_checks(customer_mart_checks(mart)).select("failures")) == Counter({(0,): 2})
    assert customer_mart(first).columns == mart.columns


def reading(city: str, country: str, updated: str, temperature: float):
    return {"location": {"name": city, "region": f"{city} region", "country": country},
            "current": {"last_updated": updated, "temp_c": temperature, "wind_kph": 10.0, "humidity": None}}


def messages(spark, *records, offset: int = 0):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame(
        [(None, bytearray(t, "utf8"), "weather", 0, offset + i, JANUARY, 0) for i, t in enumerate(texts)], ENVELOPE)


def run_stream(spark, topic, path, checkpoint):
    query = ingest(open_files(spark, topic), path, checkpoint, until_caught_up=True)
    query.awaitTermination()
    return read_table(spark, path)


def test_weather_from_topic_to_summary(spark, tmp_path):
    topic, streaming, checkpoint, data = (f"{tmp_path}/{n}" for n in ("topic", "streaming", "checkpoint", "data"))
    messages(spark, reading("Ede", "Netherlands", "2024-01-01 10:00", 4.0), reading("Gent", "Belgium", "2024-01-01 10:00", 6.0),
             reading("Bonn", "Germany", "2024-01-01 10:00", 9.0), "{not json").write.parquet(topic)
    received = run_stream(spark, topic, streaming, checkpoint)
    assert received.count() == 4 and received.schema.simpleString() == WEATHER.simpleString()
    weather.load_new(spark, streaming, data, new_keys="keep")
    messages(spark, reading("Ede", "Netherlands", "2024-01-01 11:00", 8.0),
             reading("Breda", "Netherlands", "2024-01-01 11:00", 1.0), offset=4).write.mode("append").parquet(topic)
    assert run_stream(spark, topic, streaming, checkpoint).count() == 6
    assert run_stream(spark, topic, streaming, checkpoint).count() == 6
    for _ in range(2):  # the second run finds nothing new, and Breda is a new city
        weather.load_new(spark, streaming, data)
        summary = weather.publish(spark, data)
        assert summary.columns == ["country", "region", "city", "temperature", "windspeed", "number_of_rows", "modifiedon"]
        assert bag(summary) == Counter([
            ("Netherlands", "Ede region", "Ede", 6.0, 10.0, 2, "2024-01-01 11:00"),
            ("Belgium", "Gent region", "Gent", 6.0, 10.0, 1, "2024-01-01 10:00")])


def test_stream_goes_on_with_a_wider_record(spark, tmp_path):
    topic, path, checkpoint = (f"{tmp_path}/{n}" for n in ("topic", "path", "checkpoint"))
    schemas = [spark.createDataFrame([], ddl).schema for ddl in ("a int", "a int, b string")]
    for n, schema in enumerate(schemas):
        messages(spark, {"a": n, "b": f"text {n}"}, offset=n).write.mode("append").parquet(topic)
        ingest(open_files(spark, topic), path, checkpoint, schema, until_caught_up=True).awaitTermination()
    assert bag(read_table(spark, path, merge_schema=True).select("a", "b")) == Counter([(0, None), (1, "text 1")])


def test_stream_goes_on_after_a_failure(spark, tmp_path):
    """A batch that fails is read again by the next run, and rows of finished batches are not."""
    topic, path, checkpoint = (f"{tmp_path}/{n}" for n in ("topic", "path", "checkpoint"))
    for n in range(3):
        messages(spark, {"a": n}, offset=n).coalesce(1).write.mode("append").parquet(topic)
    source = open_files(spark, topic, files_per_batch=1)
    failing = source.withColumn("value", F.when(F.col("offset") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        ingest(failing, path, checkpoint, "a int", until_caught_up=True).awaitTermination()
    for _ in range(2):
        ingest(open_files(spark, topic, files_per_batch=1), path, checkpoint, "a int", until_caught_up=True).awaitTermination()
        assert bag(read_table(spark, path)) == Counter([(0,), (1,), (2,)])


def test_summary_counts_only_stamped_rows(rows):
    df = rows("c string, x double, t string", ("a", 1.0, "2"), ("a", None, "1"), ("a", 3.0, None), (None, 1.0, "1"))
    assert bag(weather.summarise(df, ["c"], ["x"], "t")) == Counter([("a", 2.0, 2, "2"), (None, 1.0, 1, "1")])


def test_partition_values_stay_text(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    append_partitioned(rows("k string, v int", ("01", 1), ("2024-01-01", 2), (None, 3)), path, ["k"])
    assert bag(read_table(spark, path)) == Counter([(1, "01"), (2, "2024-01-01"), (3, None)])


def test_partitioned_files_are_not_slivers(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_partitioned(spark.range(1000, numPartitions=20).withColumn("k", F.col("id") % 3), path, ["k"])
    assert len(read_table(spark, path).inputFiles()) == 3


def test_hot_partition_value_is_split(spark, tmp_path):
    path = f"{tmp_path}/t"
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    rows = spark.range(200_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"), key.alias("k"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "500KB")
    try:
        append_partitioned(rows, path, ["k"])
    finally:
        spark.conf.set(size, before)
    files = Counter(f.split("/")[-2] for f in read_table(spark, path).inputFiles())
    assert files["k=0"] > 3
    assert read_table(spark, path).count() == 200_000


def test_tables_and_views(spark, rows, tmp_path):
    df = rows("id int", 1, 2)
    overwrite(df, f"{tmp_path}/o")
    overwrite(df.limit(1), f"{tmp_path}/o")
    assert read_table(spark, f"{tmp_path}/o").count() == 1
    assert as_view(df, "v_test").count() == 2
    for _ in range(2):
        assert as_table(df, "t_test").count() == 2
    spark.sql("drop table t_test")
    spark.catalog.dropTempView("v_test")


def test_incremental_model_may_repeat_rows(spark, rows, tmp_path):
    df = rows("id int", 1)
    for expected in (1, 2):
        assert write_incremental(spark, f"{tmp_path}/m", lambda standing: df).count() == expected


class RecordedWriter:
    """Takes the calls a DataFrameWriter would get."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = kwargs or args
            return self

        return call


class Recorded:
    def __init__(self):
        self.write = RecordedWriter()


def test_jdbc_options():
    df = Recorded()
    write_jdbc(df, "jdbc:postgresql://db/marts", "weather", user="u", password="p", driver="org.postgresql.Driver", connections=4)
    assert df.write.calls == {
        "format": ("jdbc",), "mode": ("overwrite",), "save": (),
        "options": {"url": "jdbc:postgresql://db/marts", "dbtable": "weather", "user": "u", "password": "p",
                    "driver": "org.postgresql.Driver", "numPartitions": "4", "truncate": "false"}}


def test_topic_options_come_from_the_session(spark):
    class Session:
        conf, sparkContext = spark.conf, spark.sparkContext
        readStream = RecordedWriter()

    for name, value in (("spark.kafka_controller", "broker:9092"), ("spark.kafka_topic", "weather"), ("spark.kafka_group_id", "g")):
        spark.conf.set(name, value)
    open_topic(Session, maxOffsetsPerTrigger="10")
    assert Session.readStream.calls["format"] == ("kafka",)
    assert Session.readStream.calls["options"] == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "weather", "kafka.group.id": "g", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10"}


def test_compaction_keeps_content(spark, tmp_path):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("k"), F.lit(None).cast("int").alias("n"))
    df.unionAll(df.limit(3)).repartition(25).write.parquet(f"{tmp_path}/a")
    merged = maintenance.compact(spark, f"{tmp_path}/a", f"{tmp_path}/b", exact_check=True)
    assert len(merged.inputFiles()) == 1 and merged.count() == 503
    several = maintenance.compact(spark, f"{tmp_path}/a", f"{tmp_path}/c", target_bytes=4000)
    assert 2 < len(several.inputFiles()) < 25
    df.repartition(9).write.partitionBy("k").parquet(f"{tmp_path}/p")
    size_setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size_setting)
    merged = maintenance.compact(spark, f"{tmp_path}/p", f"{tmp_path}/q", ["k"])
    assert len(merged.inputFiles()) == 7 and spark.conf.get(size_setting) == before


@pytest.fixture
def guessed_partition_types(spark):
    """Spark's default: folder names that look like numbers are numbers."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(name, "true")
    yield
    spark.conf.set(name, "false")


def test_compaction_keeps_folder_names(spark, rows, tmp_path, guessed_partition_types):
    rows("id int, k string", (1, "01"), (2, "01"), (3, "1")).write.partitionBy("k").parquet(f"{tmp_path}/a")
    maintenance.compact(spark, f"{tmp_path}/a", f"{tmp_path}/b", ["k"])
    assert sorted(p.name for p in (tmp_path / "b").glob("k=*")) == ["k=01", "k=1"]


def test_cities_may_look_like_numbers(spark, tmp_path, guessed_partition_types):
    streaming, data = f"{tmp_path}/streaming", f"{tmp_path}/data"
    for hour in ("10", "11"):
        texts = [json.dumps(reading(city, "Belgium", f"2024-01-01 {hour}:00", 4.0)) for city in ("007", "7")]
        spark.read.schema(WEATHER).json(spark.sparkContext.parallelize(texts)).write.mode("append").parquet(streaming)
        weather.load_new(spark, streaming, data, new_keys="keep" if hour == "10" else "drop")
    summary = weather.publish(spark, data)
    assert bag(summary.select("city", "number_of_rows")) == Counter([("007", 2), ("7", 2)])


def test_lost_rows_are_noticed(spark, rows):
    a = rows("x int, y string", (1, "a"), (1, "a"), (2, None))
    assert maintenance.same_content(a, a.select("y", "x").select("x", "y"))
    for other in (a.limit(2), rows("x int, y string", (1, "a"), (2, None), (2, None)), rows("x int, y string", (1, "a"), (1, None), (2, "a"))):
        assert not maintenance.same_content(a, other)
        assert not maintenance.same_content(a, other, exact=True)


def test_stale_files(spark, rows, tmp_path):
    for version in ("v1", "v2"):
        rows("id int", 1).coalesce(1).write.parquet(f"{tmp_path}/t/{version}")
    live = [f"{tmp_path}/t/v2"]
    assert maintenance.stale_files(spark, f"{tmp_path}/t", live).isEmpty()
    later = datetime.now() + timedelta(hours=200)
    found = maintenance.stale_files(spark, f"{tmp_path}/t", live, now=later).collect()
    assert len(found) == 1 and "/v1/" in found[0].path and found[0].length > 0
    assert maintenance.stale_files(spark, f"{tmp_path}/t", live, now=later, retention_hours=400).isEmpty()


def test_checksum_sees_where_a_null_stands_and_takes_maps(spark):
    schema = "a string, b string"
    one, two = spark.createDataFrame([(None, "x")], schema), spark.createDataFrame([("x", None)], schema)
    assert not maintenance.same_content(one, two)
    maps = "m map<string,int>, s struct<a: int, b: int>"
    same = [spark.createDataFrame([(m, (1, None))], maps) for m in ({"k": 1, "j": None}, {"j": None, "k": 1})]
    assert maintenance.same_content(*same)
    assert not maintenance.same_content(same[0], spark.createDataFrame([({"k": 1, "j": 2}, (1, None))], maps))
    assert not maintenance.same_content(same[0], spark.createDataFrame([({"k": 1, "j": None}, (None, 1))], maps))


def test_compaction_leaves_the_settings_of_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(100).repartition(5).write.parquet(f"{tmp_path}/a")
    maintenance.compact(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
