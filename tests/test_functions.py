from __future__ import annotations

import hashlib
from datetime import date, datetime, timedelta
from itertools import product

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.functions.columns import ordering
from millrace.functions.dates import UNITS
from millrace.functions.web import parsed_part
from millrace.operators.quality import sequential_values
from millrace.sources.series import date_spine


def values(df, *columns):
    out = [tuple(r) for r in df.select(*columns).collect()]
    return [r[0] for r in out] if len(columns) == 1 else out


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key(rows):
    df = rows("a string, b int", ("x", 1), (None, 1), ("", 1), (None, None))
    mark = "_dbt_utils_surrogate_key_null_"
    assert values(df, fn.surrogate_key("a", "b")) == [
        md5("x-1"), md5(f"{mark}-1"), md5("-1"), md5(f"{mark}-{mark}")]
    assert values(df, fn.surrogate_key("a", "b", nulls_as_empty=True)) == [md5("x-1"), md5("-1"), md5("-1"), md5("-")]
    with pytest.raises(ValueError):
        fn.surrogate_key()


def test_null_safe_arithmetic(rows):
    df = rows("a int, b int, c int", (7, 2, 1), (None, 2, 1), (7, None, None), (None, None, None))
    assert values(df, fn.safe_add(["a", "b", "c"])) == [10, 3, 7, 0]
    assert values(df, fn.safe_subtract(["a", "b", "c"])) == [4, -3, 7, 0]
    with pytest.raises(TypeError):
        fn.safe_add("a")


def test_safe_divide(rows):
    df = rows("n int, d int", (6, 3), (6, 0), (None, 3), (0, 5), (6, None))
    assert values(df, fn.safe_divide("n", "d")) == [2.0, None, None, 0.0, None]
    assert values(df, fn.safe_divide("n + 3", "d - 3")) == [None, -3.0, None, 1.5, None]


def test_width_bucket(rows):
    df = rows("x double", 4.9, 5.0, 14.9, 15.0, 24.9, 25.0, 700.0, None)
    assert values(df, fn.width_bucket("x", 5, 25, 2)) == [0, 1, 1, 2, 2, 3, 3, None]


def test_haversine(rows):
    df = rows("a double, b double, c double, d double", (52.37, 4.90, 50.85, 4.35), (0.0, 0.0, 0.0, 0.0))
    miles = values(df, fn.haversine_distance("a", "b", "c", "d"))
    assert miles[0] == pytest.approx(107.8, abs=0.2) and miles[1] == 0
    kilometres = values(df, fn.haversine_distance("a", "b", "c", "d", unit="km"))
    assert kilometres[0] == pytest.approx(miles[0] * 1.60934)
    with pytest.raises(ValueError):
        fn.haversine_distance("a", "b", "c", "d", unit="m")


URLS = {
    "http://a.example/x/y?ref=1&q=2": ("a.example", "x/y", "1"),
    "https://a.example?ref=": ("a.example", "", None),
    "android-app://app.example/z": ("app.example", "/app.example/z", None),
    "b.example": ("b.example", "b.example", None),
    "b.example#top": ("b.example#top", "b.example#top", None),
    "b.example?next=/home": ("b.example", "home", None),
    "b.example/p?href=9": ("b.example", "p", "9"),
    "": ("", "", None),
}


def test_url_parts(rows):
    df = rows("u string", *URLS, None)
    found = values(df, "u", fn.url_host("u"), fn.url_path("u"), fn.url_parameter("u", "ref"))
    assert {u: tuple(parts) for u, *parts in found} == {**URLS, None: (None, None, None)}
    assert values(rows("u string", "http://a.example/x?href=9", "no url"), parsed_part("u", "QUERY", "ref")) == [None, None]


@pytest.mark.parametrize("text, expected", [
    ("Hello  World-!", "hello_world_"), ("Crème", "crme"), ("9 lives", "_9_lives"), ("a--b c", "a_b_c"), ("", "")])
def test_slug(rows, text, expected):
    assert fn.slug(text) == expected
    assert values(rows("s string", text), fn.slugify("s")) == [expected]


def test_casts(rows):
    df = rows("s string", "12", "x", "", None)
    assert values(df, fn.safe_cast("s", "int")) == [12, None, None, None]
    assert values(df, fn.empty_to_null("s")) == ["12", "x", None, None]
    assert values(rows("b boolean", True, False, None), fn.text_of("b")) == ["true", "false", None]


CLOCK = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1000, "microsecond": 1}


def micros(t: datetime) -> int:
    return (t - datetime(1, 1, 1)) // timedelta(microseconds=1)


def boundaries(unit: str, a: datetime, b: datetime) -> int:
    """Unit starts passed on the way from a to b, by calendar arithmetic."""
    if unit == "year":
        return b.year - a.year
    if unit == "quarter":
        return (b.year - a.year) * 4 + (b.month - 1) // 3 - (a.month - 1) // 3
    if unit == "month":
        return (b.year - a.year) * 12 + b.month - a.month
    if unit == "week":  # ordinals divisible by 7 are Sundays
        return b.toordinal() // 7 - a.toordinal() // 7
    if unit == "day":
        return b.toordinal() - a.toordinal()
    return micros(b) // CLOCK[unit] - micros(a) // CLOCK[unit]


MOMENTS = [
    datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1),
    datetime(2024, 1, 6, 12), datetime(2024, 1, 7), datetime(2024, 2, 29, 5, 30, 1, 1500),
    # an hour that New York's clocks skip, and one they show twice
    datetime(2024, 3, 10, 2, 30, 0, 123_456), datetime(2024, 11, 3, 1, 30), datetime(2025, 6, 1, 0, 1)]


@pytest.fixture(params=["UTC", "America/New_York"])
def time_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_count_units(rows, time_zone):
    pairs = list(product(MOMENTS, MOMENTS))
    df = rows("a timestamp_ntz, b timestamp_ntz", *pairs)
    for unit in UNITS:
        found = values(df, "a", "b", fn.count_units(unit, "a", "b"))
        assert found == [(a, b, boundaries(unit, a, b)) for a, b in pairs], unit


def test_truncate(rows, time_zone):
    df = rows("t timestamp_ntz", *MOMENTS)
    for unit, size in CLOCK.items():
        expected = [datetime(1, 1, 1) + timedelta(microseconds=micros(t) // size * size) for t in MOMENTS]
        assert values(df, fn.truncate_to(unit, "t")) == expected, unit
    assert values(df, fn.truncate_to("day", "t")) == [datetime(t.year, t.month, t.day) for t in MOMENTS]
    assert values(df, fn.truncate_to("month", "t")) == [datetime(t.year, t.month, 1) for t in MOMENTS]
    assert values(df, fn.truncate_to("year", "t")) == [datetime(t.year, 1, 1) for t in MOMENTS]


def test_hours_follow_each_other_in_every_zone(spark, rows, time_zone):
    hours = date_spine(spark, "hour", datetime(2024, 3, 10, 0), datetime(2024, 3, 10, 5))
    expected = [datetime(2024, 3, 10, h) for h in range(5)]
    assert sorted(r[0] for r in hours.collect()) == expected
    assert sequential_values(rows("t timestamp_ntz", *expected), "t", unit="hour").isEmpty()


def test_add_and_truncate(rows):
    df = rows("t timestamp_ntz", datetime(2024, 1, 31, 5, 6, 7))
    assert values(df, fn.add_units("month", 1, "t")) == [datetime(2024, 2, 29, 5, 6, 7)]
    assert values(df, fn.truncate_to("quarter", "t")) == [datetime(2024, 1, 1)]
    assert values(df, fn.add_units("day", -1, F.lit(date(2024, 3, 1)).cast("timestamp_ntz")))[0].day == 29
    assert datetime(2024, 3, 1) - timedelta(days=1) == datetime(2024, 2, 29)
    with pytest.raises(ValueError):
        fn.add_units("fortnight", 1, "t")


@pytest.mark.parametrize("order, expected", [
    ("x", [1, 2, None]), ("x desc", [None, 2, 1]), ("x asc nulls first", [None, 1, 2]), ("x DESC NULLS LAST", [2, 1, None]),
    ("-x", [2, 1, None])])
def test_ordering(rows, order, expected):
    assert [r.x for r in rows("x int", 2, None, 1).orderBy(*ordering(order)).collect()] == expected
