from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions.columns import ordering
from millrace.operators import relations
from millrace.operators.relations import (
    column_value_list,
    column_values,
    deduplicate,
    differences,
    latest_per_key,
    repeat_rows,
    single_value,
    top_values,
    union_relations,
)
from tests.conftest import bag


@pytest.fixture
def two(rows):
    return {
        "t1": rows("id int, town string, code string", (1, "Ede", "x7"), (2, "Gent", "90"), (3, "Breda", "y")),
        "t2": rows("id int, river string, code int", (1, "Leie", 55), (2, "Mark", 61)),
    }


def test_union_takes_the_first_type_and_all_columns(two):
    df = union_relations(two)
    assert df.dtypes == [("_dbt_source_relation", "string"), ("id", "int"), ("town", "string"), ("code", "string"),
                         ("river", "string")]
    assert bag(df) == Counter([
        ("t1", 1, "Ede", "x7", None), ("t1", 2, "Gent", "90", None), ("t1", 3, "Breda", "y", None),
        ("t2", 1, None, "55", "Leie"), ("t2", 2, None, "61", "Mark")])


def test_union_options(two):
    assert union_relations(two, include=["ID"], source_column=None).columns == ["id"]
    assert union_relations(two, exclude=["Town", "code"], source_column="src").columns == ["src", "id", "river"]
    assert union_relations(two, column_override={"id": "bigint"}).schema["id"].dataType.simpleString() == "bigint"
    assert union_relations(two, include=["town"], where="id = 2").count() == 2
    with pytest.raises(ValueError):
        union_relations(two, include=["id"], exclude=["town"])
    with pytest.raises(ValueError):
        union_relations(two, include=["nothing"])


def test_deduplicate_keeps_nulls(rows):
    df = rows("user int, event string, version int", (1, "a", 1), (1, None, 2), (None, "c", 3), (None, "d", None))
    assert bag(deduplicate(df, "user", "version desc")) == Counter([(1, None, 2), (None, "d", None)])
    assert bag(deduplicate(df, "user", "version desc nulls last")) == Counter([(1, None, 2), (None, "c", 3)])
    assert bag(deduplicate(df, ["user is null"], [F.col("version").asc()])) == Counter([(1, "a", 1), (None, "d", None)])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3))),
                min_size=1, max_size=12),
       st.sampled_from([["x desc", "y desc"], ["x", "y"], ["x desc nulls last", "y desc"], ["x nulls first", "y"]]))
def test_deduplicate_both_ways(spark, data, order):
    df = spark.createDataFrame(data, "k int, x int, y int")
    assert bag(deduplicate(df, "k", order)) == bag(deduplicate(df, "k", ordering(order)))


def test_deduplicate_twice_changes_nothing(rows):
    df = rows("k int, v int", *[(i % 5, i) for i in range(40)])
    once = deduplicate(df, "k", "v desc")
    assert bag(once) == bag(deduplicate(once, "k", "v desc")) == bag(latest_per_key(df, "k", "v"))


def test_latest_per_key_ranks_null_lowest(rows):
    df = rows("k int, t int, id int", (1, None, 9), (1, 3, 1), (1, 3, 2), (2, None, 5))
    assert bag(latest_per_key(df, "k", ["t", "id"])) == Counter([(1, 3, 2), (2, None, 5)])


def test_column_values(rows):
    df = rows("f string, w int", ("a", 1), ("b", 1), ("b", 2), (None, 1), ("c", 2), ("c", 2), ("c", 1))
    assert column_value_list(df, "f") == ["c", "b", "a", None]
    assert column_value_list(df, "f", max_records=2) == ["c", "b"]
    assert column_value_list(df, "f", where="w = 1", order_by=["max(w)", "f desc nulls last"]) == ["c", "b", "a", None]
    assert column_value_list(df, "f", where="w = 9", default=["z"]) == ["z"]
    assert column_value_list(df, "f", where="w = 9") == []
    assert column_value_list(None, "f", default=[]) == []
    assert column_values(df, "upper(f)").columns == ["value"]
    with pytest.raises(ValueError):
        column_value_list(None, "f")
    with pytest.raises(ValueError):
        column_value_list(df, "f", most=3)


def test_single_value(rows):
    df = rows("a int, b int", (None, 1))
    assert bag(single_value(df, 7)) == Counter([(None,)])
    assert bag(single_value(df.where("b = 2"), 7)) == Counter([(7,)])
    assert bag(single_value(df.where("b = 2"))) == Counter([(None,)])
    assert bag(single_value(df.select("b", "a"), 7, name="first")) == Counter([(1,)])


def test_repeat_rows(rows, monkeypatch):
    monkeypatch.setattr(relations, "BLOCK_BITS", 2)
    df = rows("v string, n bigint", ("none", 0), ("one", 1), ("four", 4), ("nine", 9))
    assert bag(repeat_rows(df, "n")) == Counter({("one",): 1, ("four",): 4, ("nine",): 9})


def test_differences(rows):
    a = rows("x int, y string", (1, "a"), (1, "a"), (2, None), (3, "c"), (3, "c"))
    b = rows("y string, x int", (None, 2), ("a", 1), ("d", 4), ("c", 3), ("c", 3), ("c", 3))
    assert bag(differences(a, b)) == Counter([("b_minus_a", 4, "d")])
    assert bag(differences(a, b, multiset=True)) == Counter(
        [("a_minus_b", 1, "a"), ("b_minus_a", 4, "d"), ("b_minus_a", 3, "c")])
    assert bag(differences(a, b, columns=["y"])) == Counter([("b_minus_a", "d")])
    assert differences(a, a).isEmpty() and differences(a, a, multiset=True).isEmpty()


cells = st.one_of(st.none(), st.integers(0, 3))
tables = st.lists(st.tuples(cells, cells), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables, tables)
def test_differences_against_sets_and_bags(spark, left, right):
    a, b = (spark.createDataFrame(t, "x int, y int") for t in (left, right))
    sets = [("a_minus_b", *r) for r in set(left) - set(right)] + [("b_minus_a", *r) for r in set(right) - set(left)]
    assert bag(differences(a, b)) == Counter(sets)
    bags = Counter({("a_minus_b", *r): n for r, n in (Counter(left) - Counter(right)).items()})
    bags += Counter({("b_minus_a", *r): n for r, n in (Counter(right) - Counter(left)).items()})
    assert bag(differences(a, b, multiset=True)) == bags


def test_union_takes_names_in_any_letter_case(spark):
    a, b = spark.createDataFrame([(1, "x")], "ID int, v string"), spark.createDataFrame([("y", 2)], "V string, id int")
    found = union_relations({"a": a, "b": b}, column_override={"id": "bigint"}, source_column=None)
    assert found.columns == ["ID", "v"] and found.schema["ID"].dataType.simpleString() == "bigint"
    assert bag(found) == Counter({(1, "x"): 1, (2, "y"): 1})
    with pytest.raises(ValueError):
        union_relations({"a": a}, column_override={"other": "int"})


def test_names_with_dots_and_blanks(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 6.0)], "`a.b` string, `c d` int, `e f` double")
    assert deduplicate(df, "a.b", F.col("`c d`").desc()).collect()[0][1] == 2
    assert latest_per_key(df, "a.b", "c d").collect()[0][1] == 2


@pytest.mark.parametrize("tracked", [1 << 16, 64])
@pytest.mark.parametrize("values", ["few heavy", "all alike", "one only", "none"])
def test_top_values_are_exact_whatever_the_sketch_says(spark, values, tracked):
    """With few tracked items and even counts the bound cannot decide, and all values are counted."""
    number = {"few heavy": F.when(F.col("id") % 3 > 0, F.col("id") % 7).otherwise(F.col("id")), "all alike": F.col("id") % 1_000,
              "one only": F.lit(5).cast("long"), "none": F.lit(None).cast("long")}[values]
    df = spark.range(6_000).select(number.alias("v"))
    found = [r["value"] for r in top_values(df, "v", 5, tracked=tracked).collect()]
    assert found == [r["value"] for r in column_values(df, "v", max_records=5).collect()]


def test_value_lists_are_bounded_unless_asked(spark):
    df = spark.range(20_000)
    with pytest.raises(ValueError, match="more than"):
        column_value_list(df, "id")
    assert len(column_value_list(df, "id", most=None)) == 20_000
