from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.sources.catalog import normal_table_type, open_relations, relations_by_pattern, relations_by_prefix
from millrace.sources.feed import ENVELOPE, WEATHER, avro_schema, decode_messages
from millrace.sources.series import date_spine, intervals_between, number_series
from millrace.sources.tables import Source, read_json, read_seed, read_table, read_table_if_exists


def column(df):
    return [r[0] for r in df.collect()]


def test_number_series(spark):
    assert sorted(column(number_series(spark, 10))) == list(range(1, 11))
    with pytest.raises(ValueError):
        number_series(spark, 0)


def test_spine_leaves_out_the_end(spark):
    days = date_spine(spark, "day", date(2024, 1, 1), date(2024, 1, 10))
    assert days.columns == ["date_day"]
    assert sorted(column(days)) == [date(2024, 1, d) for d in range(1, 10)]
    hours = date_spine(spark, "hour", datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 1))
    assert sorted(column(hours)) == [datetime(2024, 1, 1, 22), datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 0)]
    months = date_spine(spark, "month", "date'2024-01-31'", "date'2024-04-01'")
    assert sorted(column(months)) == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)]


def test_spine_needs_an_interval(spark):
    with pytest.raises(ValueError):
        date_spine(spark, "day", date(2024, 1, 2), date(2024, 1, 2))
    with pytest.raises(ValueError):
        date_spine(spark, "decade", date(2024, 1, 2), date(2034, 1, 2))


def test_intervals_between(spark):
    assert intervals_between(spark, date(2024, 1, 31), date(2024, 3, 1), "month") == 2
    assert intervals_between(spark, "cast(null as date)", date(2024, 3, 1), "month") == 1


def test_spine_between_values_of_a_table(spark, rows):
    days = rows("d date", date(2024, 5, 1), date(2024, 5, 4), date(2024, 5, 3))
    spine = date_spine(spark, "day", days.agg(F.min("d")).scalar(), days.agg(F.max("d")).scalar())
    assert sorted(column(spine)) == [date(2024, 5, d) for d in (1, 2, 3)]


def test_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes(b"\xef\xbb\xbfid,name,score\n1,a,0.5\n2,,\n")
    typed = read_seed(spark, str(path), "id int, name string, score double")
    assert [tuple(r) for r in typed.orderBy("id").collect()] == [(1, "a", 0.5), (2, None, None)]
    assert read_seed(spark, str(path)).columns == ["id", "name", "score"]


def test_json_schema_is_found(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"location": {"name": "Ede", "lat": 52.0}}\n')
    (tmp_path / "b.json").write_text('{"location": {"name": "Gent"}, "current": {"temp_c": 3.5}}\n')
    df = read_json(spark, str(tmp_path))
    found = {tuple(r) for r in df.select("location.name", "location.lat", "current.temp_c").collect()}
    assert found == {("Ede", 52.0, None), ("Gent", None, 3.5)}
    assert column(read_json(spark, str(tmp_path), "current struct<temp_c double>").select("current.temp_c").distinct()
                  .orderBy("temp_c")) == [None, 3.5]


def test_source(spark, rows, tmp_path):
    rows("id int", 1, 2).write.parquet(f"{tmp_path}/customer.parquet")
    source = Source(spark, str(tmp_path), ("customer",))
    source.register()
    assert spark.table("customer").count() == source.table("customer").count() == 2
    with pytest.raises(KeyError):
        source.table("orders")
    spark.catalog.dropTempView("customer")


def test_missing_table(spark, tmp_path):
    assert read_table_if_exists(spark, f"{tmp_path}/nothing") is None


def test_columns_that_came_later(spark, rows, tmp_path):
    rows("id int", 1).write.parquet(f"{tmp_path}/t")
    rows("id int, name string", (2, "b")).write.mode("append").parquet(f"{tmp_path}/t")
    merged = read_table(spark, f"{tmp_path}/t", merge_schema=True)
    assert {tuple(r) for r in merged.select("id", "name").collect()} == {(1, None), (2, "b")}


def test_relations_by_name(spark, rows):
    for name in ("day_20240101", "day_20240102", "dayx20240103", "other"):
        rows("id int", 1).createOrReplaceTempView(name)
    spark.sql("create table day_20240104 using parquet as select 4 as id")
    try:
        def names(found):
            return {(r.table_name, r.table_type) for r in found.collect()}

        views = {("day_20240101", "temporary"), ("day_20240102", "temporary"), ("dayx20240103", "temporary")}
        assert names(relations_by_pattern(spark, "%", "DAY%")) == views | {("day_20240104", "table")}
        assert names(relations_by_prefix(spark, "%", "day_", exclude="%0101")) == {
            ("day_20240102", "temporary"), ("dayx20240103", "temporary"), ("day_20240104", "table")}
        in_schema = relations_by_pattern(spark, "DEFAULT", "day%")
        assert names(in_schema) == {("day_20240104", "table")}
        [(name, opened)] = open_relations(spark, in_schema).items()
        assert name.endswith("default.day_20240104") and column(opened) == [4]
        assert names(relations_by_pattern(spark, "nowhere", "%")) == set()
    finally:
        spark.sql("drop table day_20240104")
        for name in ("day_20240101", "day_20240102", "dayx20240103", "other"):
            spark.catalog.dropTempView(name)


def test_table_types(rows):
    df = rows("t string", "BASE TABLE", "MANAGED", "EXTERNAL", "FOREIGN", "MATERIALIZED VIEW", "VIEW")
    assert column(df.select(normal_table_type(F.col("t")))) == [
        "table", "table", "external", "external", "materializedview", "view"]


def test_unreadable_message_gives_nulls(spark):
    good = json.dumps({"location": {"name": "Ede", "country": "Netherlands"}, "current": {"temp_c": 4.5}})
    messages = spark.createDataFrame(
        [(None, bytearray(v, "utf8"), "weather", 0, i, None, 0) for i, v in enumerate([good, "{broken", ""])]
        + [(None, None, "weather", 0, 3, None, 0)], ENVELOPE)
    decoded = decode_messages(messages, WEATHER)
    assert decoded.schema == WEATHER
    assert sorted(column(decoded.select("location.name")), key=str) == ["Ede", None, None, None]


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        decode_messages(spark.createDataFrame([], ENVELOPE), WEATHER, codec="xml")


def test_avro_schema_mirrors_the_record():
    schema = json.loads(avro_schema(WEATHER, "Weather"))
    assert [f["name"] for f in schema["fields"]] == ["location", "current", "forecast"]
    days = schema["fields"][2]["type"]["fields"][0]["type"]
    assert days["type"] == "array" and days["items"]["fields"][1] == {"name": "date_epoch", "type": "long"}


def test_a_cluster_needs_a_shared_folder(spark):
    class Cluster:
        class sparkContext:
            master, applicationId = "spark://host", "app-1"

            @staticmethod
            def getConf():
                return {}

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster)
    Cluster.conf.get = staticmethod(lambda name, default: "s3a://shared/")
    assert session.shared_folder(Cluster) == "s3a://shared/millrace-app-1"


def test_stage_goes_to_the_shared_folder(spark, rows):
    staged = session.stage(rows("id int", 1, 2))
    assert staged.count() == 2
    assert all(f.startswith(f"file://{spark.conf.get('spark.checkpoint.dir')}") for f in staged.inputFiles())


def test_seed_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,note\n1,"say ""hi"", ok"\n2,"two\nlines"\n3,\n4,plain\n')
    rows = [tuple(r) for r in read_seed(spark, str(tmp_path / "s.csv")).collect()]
    assert rows == [("1", 'say "hi", ok'), ("2", "two\nlines"), ("3", None), ("4", "plain")]


def test_json_over_several_lines(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": 1,\n "b": {\n  "c": "x"\n }\n}\n')
    assert [tuple(r) for r in read_json(spark, str(tmp_path / "d.json"), multi_line=True).select("a", "b.c").collect()] == [(1, "x")]
