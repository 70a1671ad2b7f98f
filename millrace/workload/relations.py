"""Transforms of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import slug
from millrace.operators.relations import (
    column_value_list,
    column_values,
    deduplicate,
    differences,
    latest_per_key,
    single_value,
    top_values,
    union_relations,
)
from millrace.operators.shaping import leading_columns, nullcheck, pivot, star, unpivot
from millrace.sources.catalog import open_relations, relations_by_pattern, relations_by_prefix
from millrace.workload.registry import query


@query("star_except", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def star_except(t):
    return t.orders.select(star(t.orders, exclude=["O_ORDERSTATUS", "o_orderpriority"]))


@query("star_prefix", """
SELECT s_suppkey AS raw_s_suppkey_v1, s_name AS raw_s_name_v1, s_nationkey AS raw_s_nationkey_v1,
       s_acctbal AS raw_s_acctbal_v1 FROM supplier
""")
def star_prefix(t):
    return t.supplier.select(star(t.supplier, prefix="raw_", suffix="_v1"))


@query("star_group", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys
FROM orders GROUP BY o_orderstatus, o_orderpriority
""")
def star_group(t):
    kept = star(t.orders, exclude=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return t.orders.groupBy(kept).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))


@query("group_by_position", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def group_by_position(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return rows.groupBy(leading_columns(rows, 2)).agg(F.count(F.lit(1)).alias("n"))


@query("nullcheck", """
SELECT c_custkey, nullif(regexp_replace(c_name, '^Customer#[0-9]*[05]$', ''), '') AS c_name, c_nationkey,
       nullif(replace(c_mktsegment, 'BUILDING', ''), '') AS c_mktsegment
FROM customer
""")
def null_for_empty(t):
    return nullcheck(t.customer.select(
        "c_custkey",
        F.regexp_replace("c_name", "^Customer#[0-9]*[05]$", "").alias("c_name"),
        "c_nationkey",
        F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("")).alias("c_mktsegment"),
    ))


@query("column_values", """
SELECT p_brand AS value FROM part WHERE p_size > 10 GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5
""")
def top_brands(t):
    return column_values(t.part, "p_brand", max_records=5, where="p_size > 10")


@query("column_values_sketch", """
SELECT l_partkey AS value FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 20
""")
def column_values_sketch(t):
    """The most frequent parts, of which only candidates that a sketch names are counted and shuffled."""
    return top_values(t.lineitem, "l_partkey", 20)


@query("single_value", """
SELECT 'largest' AS which, max(o_totalprice) AS value FROM orders
UNION ALL SELECT 'missing', CASE WHEN count(*) = 0 THEN -1 ELSE max(o_totalprice) END FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'null', max(nullif(o_totalprice, o_totalprice)) FROM orders
""")
def first_values(t):
    price = t.orders.select("o_totalprice")
    found = {
        "largest": single_value(price.agg(F.max("o_totalprice")), -1.0),
        "missing": single_value(price.where("o_totalprice < 0"), -1.0),
        "null": single_value(price.agg(F.max(F.nullif("o_totalprice", "o_totalprice"))), -1.0),
    }
    return reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("which"), "value") for name, df in found.items()])


def parties(t) -> dict[str, DataFrame]:
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"))
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").cast("decimal(12,2)").alias("balance"))
    return {"customer": customers, "supplier": suppliers}


@query("union_relations", """
SELECT 'customer' AS _dbt_source_relation, c_custkey AS id, c_name AS name, c_mktsegment AS segment,
       CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS balance FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR),
       CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) FROM supplier
""")
def union_all_columns(t):
    return union_relations(parties(t), column_override={"balance": "string"})


@query("union_include", """
SELECT 'customer' AS origin, c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
UNION ALL SELECT 'supplier', s_suppkey, CAST(s_nationkey AS VARCHAR) FROM supplier
""")
def union_include(t):
    return union_relations(parties(t), include=["ID", "nation"], source_column="origin")


@query("union_exclude", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def union_exclude(t):
    return union_relations(parties(t), exclude=["Nation", "balance"], source_column=None)


@query("union_where", """
SELECT 'customer' AS _dbt_source_relation, c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey > 12
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier WHERE s_nationkey > 12
""")
def union_where(t):
    return union_relations(parties(t), include=["id", "name"], where="cast(nation as int) > 12")


@query("union_by_pattern", """
SELECT 'found_events_' || event_type AS _dbt_source_relation, event_id, event_type, value
FROM events WHERE event_type <> 'error'
""")
def union_by_pattern(t):
    """Views per event type, found by their names and put together again."""
    kinds = column_value_list(t.events, "event_type", where="event_type is not null")
    views = [f"found_events_{kind}" for kind in kinds]
    for kind, view in zip(kinds, views, strict=True):
        rows = t.events.where(F.col("event_type") == kind).select("event_id", "event_type", "value")
        rows.createOrReplaceTempView(view)
    try:
        found = relations_by_pattern(t.spark, "%", "FOUND_events%", exclude="%_error")
        again = relations_by_prefix(t.spark, "%", "found_events_", exclude="%_error")
        opened = open_relations(t.spark, found)
        if opened.keys() != open_relations(t.spark, again).keys():
            raise RuntimeError("pattern and prefix find different relations")
        return union_relations(opened)
    finally:
        for view in views:
            t.spark.catalog.dropTempView(view)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _per_priority(aggregate: str, name) -> str:
    return ", ".join(f"{aggregate.format(p=p)} AS \"{name(p)}\"" for p in PRIORITIES)


@query("pivot_sum", f"""
SELECT o_orderstatus, {_per_priority(
    "CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT)", str)}
FROM orders GROUP BY o_orderstatus
""")
def pivot_sum(t):
    priorities = column_value_list(t.orders, "o_orderpriority")
    return pivot(t.orders, "o_orderstatus", "o_orderpriority", priorities)


@query("pivot_distinct", f"""
SELECT o_orderstatus, {_per_priority(
    "count(DISTINCT CASE WHEN o_orderpriority = '{p}' THEN o_custkey END)", lambda p: "customers " + p)}
FROM orders GROUP BY o_orderstatus
""")
def pivot_distinct(t):
    priorities = column_value_list(t.orders, "o_orderpriority")
    return pivot(t.orders, "o_orderstatus", "o_orderpriority", priorities, agg="count", distinct=True,
                 then_value="o_custkey", else_value=None, prefix="customers ")


@query("pivot_distinct_default", f"""
SELECT o_orderstatus, {_per_priority(
    "CAST(count(DISTINCT CASE WHEN o_orderpriority = '{p}' THEN o_custkey % 50 ELSE 0 END) AS BIGINT)", str)}
FROM orders GROUP BY o_orderstatus
""")
def pivot_distinct_default(t):
    """Rows that do not match count as one more value, 0, which matching rows may have as well."""
    priorities = column_value_list(t.orders, "o_orderpriority")
    return pivot(t.orders, "o_orderstatus", "o_orderpriority", priorities, agg="count", distinct=True,
                 then_value="o_custkey % 50")


@query("pivot_slug", f"""
SELECT o_orderstatus, {_per_priority(
    "max(CASE WHEN o_orderpriority ILIKE '{p}' THEN o_totalprice ELSE 0 END)", lambda p: slug("max " + p))}
FROM orders GROUP BY o_orderstatus
""")
def pivot_slug(t):
    priorities = column_value_list(t.orders, "o_orderpriority")
    return pivot(t.orders, "o_orderstatus", "o_orderpriority", priorities, agg="max", comparison="ilike",
                 then_value="o_totalprice", prefix="max ", slugs=True)


@query("unpivot", """
WITH c AS (
  SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS segment,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_acctbal > 0 AS positive
  FROM customer
)
SELECT c_custkey, 'segment' AS prop, segment AS val FROM c
UNION ALL SELECT c_custkey, 'balance', CAST(balance AS VARCHAR) FROM c
UNION ALL SELECT c_custkey, 'positive', CAST(positive AS VARCHAR) FROM c
""")
def unpivot_customers(t):
    rows = t.customer.select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), (F.col("c_acctbal") > 0).alias("positive"))
    return unpivot(rows, exclude=["c_custkey"], remove=["c_name"], field_name="prop", value_name="val")


LATEST = """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
"""


@query("dedup_row_number", LATEST.format(key="user_id"))
def dedup_row_number(t):
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return deduplicate(rows, "user_id", ["ts desc", "event_id desc"])


@query("dedup_first", """
SELECT l_orderkey, l_suppkey, l_linenumber, l_shipdate FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_suppkey ORDER BY nullif(l_linenumber, 1) NULLS FIRST, l_shipdate, l_orderkey) AS rn
  FROM lineitem
) WHERE rn = 1
""")
def dedup_first(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return deduplicate(rows, "l_suppkey", ["nullif(l_linenumber, 1) nulls first", "l_shipdate", "l_orderkey"])


@query("dedup_mixed_order", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, ts, event_id) AS rn FROM events
) WHERE rn = 1
""")
def dedup_mixed_order(t):
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return deduplicate(rows, "user_id", ["event_type desc", "ts", "event_id"])


@query("dedup_max_by", LATEST.format(key="user_id % 10, event_type"))
def dedup_max_by(t):
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return latest_per_key(rows, ["user_id % 10", "event_type"], ["ts", "event_id"])


@query("except_both", """
SELECT 'a_minus_b' AS which_diff, * FROM (
  SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL
SELECT 'b_minus_a', * FROM (
  SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def except_both(t):
    pending = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key"))
    funded = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return differences(pending, funded)


@query("union_mixed_case", """
SELECT c_custkey AS key, c_name AS name, NULL::BIGINT AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey::BIGINT FROM supplier
""")
def union_mixed_case(t):
    """The same column in two spellings is one column, in the first one."""
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("KEY"), F.col("s_name").alias("Name"), F.col("s_nationkey").cast("bigint").alias("nation"))
    return union_relations({"customer": customers, "supplier": suppliers}, column_override={"NATION": "bigint"}, source_column=None)
