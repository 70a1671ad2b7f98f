from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators.shaping import filtered_columns, leading_columns, nullcheck, pivot, pivot_columns, star, unpivot
from tests.conftest import bag, plan_of


def test_star(rows):
    df = rows("`a.b` int, C string, d int", (1, "x", 2))
    assert filtered_columns(df, ["c"]) == ["a.b", "d"]
    assert df.select(star(df, exclude=["D"])).columns == ["a.b", "C"]
    assert df.select(star(df, prefix="p_", suffix="_s")).columns == ["p_a.b_s", "p_C_s", "p_d_s"]
    assert df.alias("t").select(star(df, relation_alias="t")).collect() == df.collect()
    assert star(df, exclude=df.columns) == []


def test_group_by_leading_columns(rows):
    df = rows("a int, b int, c int", (1, 1, 5), (1, 1, 6), (1, 2, 7))
    assert bag(df.groupBy(leading_columns(df, 2)).agg(F.sum("c"))) == Counter({(1, 1, 11): 1, (1, 2, 7): 1})
    with pytest.raises(ValueError):
        leading_columns(df, 4)


def test_nullcheck(rows):
    df = rows("a string, b int, `c d` string", ("", 0, ""), ("x", 1, " "), (None, None, "y"))
    assert bag(nullcheck(df)) == Counter([(None, 0, None), ("x", 1, " "), (None, None, "y")])
    assert bag(nullcheck(df, ["a"])) == Counter([(None, 0, ""), ("x", 1, " "), (None, None, "y")])
    assert nullcheck(df).schema.fieldNames() == ["a", "b", "c d"]


@pytest.fixture
def crates(rows):
    return rows("crate string, fruit string, n int", ("a", "plum", 1), ("a", "fig", 2), ("a", "plum", 1), ("b", "plum", 4),
                ("b", None, 5), ("c", "fig's", 6))


def test_pivot(crates):
    assert bag(pivot(crates, "crate", "fruit", ["plum", "fig", "fig's"])) == Counter(
        [("a", 2, 1, 0), ("b", 1, 0, 0), ("c", 0, 0, 1)])
    assert pivot(crates, "crate", "fruit", ["plum"], prefix="Is ", suffix="?").columns == ["crate", "Is plum?"]
    assert pivot(crates, "crate", "fruit", ["plum"], prefix="Is ", suffix="?", slugs=True).columns == ["crate", "is_plum"]


def test_pivot_count_needs_no_else(crates):
    assert bag(pivot(crates, "crate", "fruit", ["plum"], agg="count")) == Counter([("a", 3), ("b", 2), ("c", 1)])
    assert bag(pivot(crates, "crate", "fruit", ["plum"], agg="count", else_value=None)) == Counter(
        [("a", 2), ("b", 1), ("c", 0)])


def test_pivot_comparisons(crates):
    assert bag(pivot(crates, "crate", "fruit", ["FIG%"], comparison="ilike")) == Counter([("a", 1), ("b", 0), ("c", 1)])
    assert bag(pivot(crates, "crate", "n", [2, 5], comparison=">=", then_value="n * 10")) == Counter(
        [("a", 20, 0), ("b", 90, 50), ("c", 60, 60)])
    with pytest.raises(ValueError):
        pivot_columns("fruit", ["plum"], comparison="~")


@pytest.mark.parametrize("agg", ["sum", "count", "avg", "min", "max"])
@pytest.mark.parametrize("else_value", [None, 0])
def test_pivot_distinct(spark, crates, agg, else_value):
    crates.createOrReplaceTempView("crates")
    distinct = "" if agg in ("min", "max") else "distinct"
    branch = "" if else_value is None else f"else {else_value}"
    expected = spark.sql(f"""
        select crate, {agg}({distinct} case when fruit = 'plum' then n {branch} end) as plum,
               {agg}({distinct} case when fruit = 'fig' then n {branch} end) as fig
        from crates group by crate""")
    found = pivot(crates, "crate", "fruit", ["plum", "fig"], agg=agg, then_value="n", else_value=else_value, distinct=True)
    assert found.columns == expected.columns and bag(found) == bag(expected)


def test_pivot_without_alias(crates):
    assert len(pivot_columns("fruit", ["plum", "fig"], alias=False)) == 2
    assert "plum" not in crates.agg(*pivot_columns("fruit", ["plum"], alias=False)).columns


def test_unpivot(rows):
    df = rows("id int, at string, a string, b boolean, c int, x int", (1, "t", "v", True, None, 9), (2, "u", None, False, 3, 9))
    found = unpivot(df, exclude=["id", "AT"], remove=["X"], field_name="prop", value_name="val")
    assert found.columns == ["id", "AT", "prop", "val"]
    assert bag(found) == Counter([
        (1, "t", "a", "v"), (1, "t", "b", "true"), (1, "t", "c", None),
        (2, "u", "a", None), (2, "u", "b", "false"), (2, "u", "c", "3")])
    assert unpivot(df.select("id", "c"), cast_to="bigint", exclude=["id"]).schema["value"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        unpivot(df.select("id"), exclude=["id"])


def test_unpivot_then_pivot_gives_the_rows_back(rows):
    df = rows("id int, a int, b int", (1, 10, 20), (2, None, 40))
    long = unpivot(df, cast_to="int", exclude=["id"])
    wide = pivot(long, "id", "field_name", ["a", "b"], agg="max", then_value="value", else_value=None)
    assert bag(wide) == bag(df)


@pytest.mark.parametrize("agg", ["count", "sum", "avg", "min", "max"])
@pytest.mark.parametrize("else_value", [0, 3, None])
def test_distinct_pivot_needs_no_copies_of_rows(spark, agg, else_value):
    rows = [("g", "a", 3), ("g", "a", 3), ("g", "a", 5), ("g", "b", 0), ("g", None, 7), ("h", "a", None), ("h", "a", 4), ("i", "a", 9)]
    df = spark.createDataFrame(rows, "k string, c string, v int")
    wide = pivot(df, "k", "c", ["a", "b"], agg=agg, then_value="v", else_value=else_value, distinct=True)
    assert "Expand" not in plan_of(wide)
    other = "" if else_value is None else f"ELSE {else_value}"
    texts = {"avg": "sum(DISTINCT {0}) / count(DISTINCT {0})", "min": "min({0})", "max": "max({0})"}
    total = texts.get(agg, agg + "(DISTINCT {0})")
    expected = df.groupBy("k").agg(*[F.expr(total.format(f"CASE WHEN c = '{v}' THEN v {other} END")).alias(v) for v in "ab"])
    assert bag(wide) == bag(expected)
