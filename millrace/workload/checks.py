"""Data-quality checks, set up so that they find violations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions import truncate_to
from millrace.operators import quality as q
from millrace.operators.suite import (
    Rating,
    RowCheck,
    TableCheck,
    at_least_one_check,
    equal_rowcount_check,
    fewer_rows_check,
    not_constant_check,
    not_null_proportion_check,
    recency_check,
    run_checks,
)
from millrace.workload.registry import query

# --- row counts -----------------------------------------------------------------------------


@query("qc_equal_rowcount", """
SELECT count_a, count_b, abs(count_a - count_b) AS diff_count
FROM (SELECT count(*) AS count_a FROM orders), (SELECT count(*) AS count_b FROM lineitem)
""")
def qc_equal_rowcount(t):
    return q.equal_rowcount(t.orders, t.lineitem)


PER_STATUS = """
WITH a AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
b AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders
      WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' GROUP BY 1)
"""


def _two_sets_of_orders(t):
    orders = t.orders.select("o_orderpriority", "o_orderstatus")
    return orders.where("o_orderpriority <> '5-LOW'"), orders.where("o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'")


@query("qc_equal_rowcount_grouped", PER_STATUS + """
SELECT a.p AS o_orderpriority_a, b.p AS o_orderpriority_b, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
FROM a FULL JOIN b ON a.p = b.p
""")
def qc_equal_rowcount_grouped(t):
    return q.equal_rowcount(*_two_sets_of_orders(t), ["o_orderpriority"])


@query("qc_fewer_rows", """
SELECT a AS count_our_model, b AS count_comparison_model,
       CAST(CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM (SELECT count(*) AS a FROM orders), (SELECT count(*) AS b FROM customer)
""")
def qc_fewer_rows(t):
    return q.fewer_rows_than(t.orders, t.customer)


@query("qc_fewer_rows_grouped", PER_STATUS + """
SELECT a.p AS o_orderpriority_a, b.p AS o_orderpriority_b, a.n AS count_our_model, b.n AS count_comparison_model,
       CAST(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM a FULL JOIN b ON a.p = b.p
""")
def qc_fewer_rows_grouped(t):
    return q.fewer_rows_than(*_two_sets_of_orders(t), ["o_orderpriority"])


@query("qc_fewer_rows_strict", PER_STATUS + """
SELECT a.p AS o_orderpriority_a, b.p AS o_orderpriority_b, a.n AS count_our_model, b.n AS count_comparison_model,
       CAST(CASE WHEN coalesce(a.n, 0) > coalesce(b.n, 0) THEN coalesce(a.n, 0) - coalesce(b.n, 0)
                 WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM a FULL JOIN b ON a.p = b.p
""")
def qc_fewer_rows_strict(t):
    return q.fewer_rows_than(*_two_sets_of_orders(t), ["o_orderpriority"], strict=True)


# --- equality -------------------------------------------------------------------------------

EQUALITY = """
WITH a AS (SELECT l_suppkey, nullif(l_linestatus, 'O') AS l_linestatus, l_returnflag, l_quantity FROM lineitem),
b AS (SELECT l_suppkey, nullif(l_linestatus, 'O') AS l_linestatus, l_returnflag,
             CASE WHEN l_suppkey % 10 = 3 THEN l_quantity + 0.5 ELSE l_quantity END AS l_quantity FROM lineitem)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT {all} SELECT * FROM b)
UNION ALL
SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT {all} SELECT * FROM a)
"""


def _perturbed(t):
    a = t.lineitem.select("l_suppkey", F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"), "l_returnflag",
                          "l_quantity")
    changed = F.when(F.col("l_suppkey") % 10 == 3, F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity"))
    return a, a.withColumn("l_quantity", changed)


@query("qc_equality", EQUALITY.format(all=""))
def qc_equality(t):
    return q.equality(*_perturbed(t))


@query("qc_equality_strict", EQUALITY.format(all="ALL"))
def qc_equality_strict(t):
    return q.equality(*_perturbed(t), strict=True)


@query("qc_equality_buckets", EQUALITY.format(all="ALL"))
def qc_equality_buckets(t):
    """As above, with only the rows of differing buckets shuffled."""
    return q.equality(*_perturbed(t), strict=True, by_bucket=True)


@query("qc_cardinality", """
WITH a AS (SELECT c_nationkey AS v, count(*) AS n FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS v, count(*) AS n FROM supplier GROUP BY 1)
SELECT v AS c_nationkey, n AS num_rows FROM (
  (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))
""")
def qc_cardinality(t):
    return q.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


# --- rows and values ------------------------------------------------------------------------


@query("qc_expression", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem WHERE NOT (l_extendedprice > l_quantity * 1500)
""")
def qc_expression(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return q.expression_is_true(rows, "> l_quantity * 1500", column="l_extendedprice")


@query("qc_range", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE NOT (l_quantity > 5) OR NOT (l_quantity < 45)
""")
def qc_range(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return q.accepted_range(rows, "l_quantity", 5, "40 + 5", inclusive=False)


@query("qc_not_accepted", """
SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('5-LOW', '9-NEVER', '2-HIGH')
""")
def qc_not_accepted(t):
    return q.not_accepted_values(t.orders, "o_orderpriority", ["5-LOW", "9-NEVER", "2-HIGH"])


@query("qc_accepted", """
SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1
""")
def qc_accepted(t):
    return q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("qc_not_empty", """
SELECT trim(CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE c_mktsegment END) AS c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING'
""")
def qc_not_empty(t):
    blank = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    return q.not_empty_string(t.customer.select(blank.alias("c_mktsegment")), "c_mktsegment")


@query("qc_not_null", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS segment FROM customer WHERE c_mktsegment = 'BUILDING'")
def qc_not_null(t):
    rows = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return q.not_null(rows, "segment")


@query("qc_null_share", """
SELECT c_nationkey, round(not_null_proportion, 6) AS not_null_proportion FROM (
  SELECT c_nationkey, count(nullif(c_mktsegment, 'BUILDING')) / count(*) AS not_null_proportion
  FROM customer GROUP BY c_nationkey)
WHERE not_null_proportion < 0.8 OR not_null_proportion > 0.85
""")
def qc_null_share(t):
    rows = t.customer.select("c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    shares = q.not_null_proportion(rows, "segment", 0.8, 0.85, ["c_nationkey"])
    return shares.withColumn("not_null_proportion", F.round("not_null_proportion", 6))


@query("qc_assert_equal", """
SELECT o_orderkey, nullif(o_orderstatus, 'O') AS actual, 'F' AS expected FROM orders WHERE o_orderstatus = 'P'
""")
def qc_assert_equal(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("actual"), F.lit("F").alias("expected"))
    return q.assert_equal(rows, "actual", "expected")


@query("qc_unique", """
SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1
""")
def qc_unique(t):
    return q.unique(t.lineitem, "l_orderkey")


@query("qc_unique_combo", """
SELECT l_orderkey, nullif(l_linenumber, 7) AS line FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def qc_unique_combo(t):
    rows = t.lineitem.select("l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("line"))
    return q.unique_combination_of_columns(rows, ["l_orderkey", "line"])


# --- groups ---------------------------------------------------------------------------------


@query("qc_recency", """
SELECT max(ts) AS most_recent, TIMESTAMP '2024-01-31 00:00:00' AS threshold FROM events
HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00'
""")
def qc_recency(t):
    return q.recency(t.events, "ts", "day", 1, now=datetime(2024, 2, 1))


@query("qc_recency_grouped", """
SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-01-30' AS threshold FROM events
GROUP BY user_id HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'
""")
def qc_recency_grouped(t):
    return q.recency(t.events, "ts", "hour", 24, ignore_time=True, group_by=["user_id"], now=datetime(2024, 1, 31))


@query("qc_at_least_one", """
SELECT count(nullif(l_tax, l_tax)) AS filler_column FROM lineitem HAVING count(nullif(l_tax, l_tax)) = 0
""")
def qc_at_least_one(t):
    return q.at_least_one(t.lineitem.select(F.nullif("l_tax", "l_tax").alias("tax")), "tax")


@query("qc_at_least_one_grouped", """
SELECT l_suppkey, l_linenumber, count(CASE WHEN l_quantity > 48 THEN l_quantity END) AS filler_column
FROM lineitem GROUP BY 1, 2 HAVING count(CASE WHEN l_quantity > 48 THEN l_quantity END) = 0
""")
def qc_at_least_one_grouped(t):
    large = F.when(F.col("l_quantity") > 48, F.col("l_quantity")).alias("large")
    return q.at_least_one(t.lineitem.select("l_suppkey", "l_linenumber", large), "large", ["l_suppkey", "l_linenumber"])


@query("qc_not_constant", "SELECT count(DISTINCT l_quantity * 0) AS filler_column FROM lineitem")
def qc_not_constant(t):
    return q.not_constant(t.lineitem.select((F.col("l_quantity") * 0).alias("nothing")), "nothing")


@query("qc_not_constant_grouped", """
SELECT l_orderkey, count(DISTINCT nullif(l_returnflag, 'N')) AS filler_column FROM lineitem
GROUP BY l_orderkey HAVING count(DISTINCT nullif(l_returnflag, 'N')) = 1
""")
def qc_not_constant_grouped(t):
    rows = t.lineitem.select("l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    return q.not_constant(rows, "flag", ["l_orderkey"])


@query("qc_relationships", """
SELECT l.l_orderkey AS id, CAST(NULL AS BIGINT) AS right_id FROM lineitem l
WHERE l.l_quantity > 25
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
""")
def qc_relationships(t):
    return q.relationships_where(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "l_quantity > 25",
                                 "o_orderstatus <> 'P'")


# --- neighbours -----------------------------------------------------------------------------

RANGES = """
WITH w AS (
  SELECT {partition} CAST(o_orderdate AS DATE) AS lower_bound, CAST(o_orderdate AS DATE) + CAST({days} AS INTEGER) AS upper_bound,
    lead(CAST(o_orderdate AS DATE)) OVER o AS next_lower_bound, lead(1) OVER o IS NULL AS is_last_record
  FROM orders WINDOW o AS ({window} ORDER BY CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST({days} AS INTEGER))
),
c AS (
  SELECT *, coalesce(lower_bound {zero} upper_bound, false) AS {order_name},
         coalesce(upper_bound {gap} next_lower_bound, is_last_record) AS {gap_name}
  FROM w
)
SELECT * FROM c WHERE NOT ({order_name} AND {gap_name})
"""
BY_CUSTOMER = {"partition": "o_custkey AS partition_by_col,", "window": "PARTITION BY o_custkey"}
STRICT_ORDER = {"zero": "<", "order_name": "lower_bound_less_than_upper_bound"}
ALLOWED = {"gap": "<=", "gap_name": "upper_bound_less_than_or_equal_to_next_lower_bound"}


def _ranges(t, days: str, **options):
    day = F.to_date("o_orderdate")
    return q.mutually_exclusive_ranges(t.orders, day, F.date_add(day, F.expr(f"cast({days} as int)")), **options)


@query("qc_ranges_allowed", RANGES.format(days="90", **BY_CUSTOMER, **STRICT_ORDER, **ALLOWED))
def qc_ranges_allowed(t):
    return _ranges(t, "90", partition_by="o_custkey")


@query("qc_ranges_not_allowed", RANGES.format(
    days="90", gap="=", gap_name="upper_bound_equal_to_next_lower_bound", **BY_CUSTOMER, **STRICT_ORDER))
def qc_ranges_not_allowed(t):
    return _ranges(t, "90", partition_by="o_custkey", gaps="not_allowed")


@query("qc_ranges_required", RANGES.format(
    days="30", gap="<", gap_name="upper_bound_less_than_next_lower_bound", **BY_CUSTOMER, **STRICT_ORDER))
def qc_ranges_required(t):
    return _ranges(t, "30", partition_by="o_custkey", gaps="required")


@query("qc_ranges_zero_length", RANGES.format(
    days="o_custkey % 3 - 1", zero="<=", order_name="lower_bound_less_than_or_equal_to_upper_bound",
    **BY_CUSTOMER, **ALLOWED))
def qc_ranges_zero_length(t):
    return _ranges(t, "o_custkey % 3 - 1", partition_by="o_custkey", zero_length_range_allowed=True)


@query("qc_ranges_whole_table", RANGES.format(
    days="o_custkey % 3 - 1", partition="", window="", **STRICT_ORDER, **ALLOWED))
def qc_ranges_whole_table(t):
    """No partition: one group of all rows, cut into chunks."""
    return _ranges(t, "o_custkey % 3 - 1")


@query("qc_sequential", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber,
         lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber FROM lineitem)
WHERE NOT (l_linenumber = previous_l_linenumber + 1)
""")
def qc_sequential(t):
    return q.sequential_values(t.lineitem, "l_linenumber", group_by=["l_orderkey"])


@query("qc_sequential_dt", """
SELECT * FROM (
  SELECT event_type, date_trunc('hour', ts) AS hour,
         lag(date_trunc('hour', ts)) OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts)) AS previous_hour
  FROM events)
WHERE NOT (hour = previous_hour + INTERVAL 1 HOUR)
""")
def qc_sequential_dt(t):
    hours = t.events.select("event_type", truncate_to("hour", "ts").alias("hour"))
    return q.sequential_values(hours, "hour", unit="hour", group_by=["event_type"])


@query("qc_sequential_chunked", """
SELECT * FROM (
  SELECT l_linestatus, l_orderkey, lag(l_orderkey) OVER (PARTITION BY l_linestatus ORDER BY l_orderkey) AS previous_l_orderkey
  FROM lineitem)
WHERE NOT (l_orderkey = previous_l_orderkey + 1)
""")
def qc_sequential_chunked(t):
    """Two groups that share all rows, so both are cut into chunks."""
    return q.sequential_values(t.lineitem, "l_orderkey", group_by=["l_linestatus"])


@query("qc_sequential_whole_table", """
SELECT * FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey FROM lineitem)
WHERE NOT (l_orderkey = previous_l_orderkey + 1)
""")
def qc_sequential_whole_table(t):
    return q.sequential_values(t.lineitem, "l_orderkey")


# --- suite ----------------------------------------------------------------------------------


@query("qc_suite", """
SELECT 'quantity in range' AS check_name, count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 45) AS failures,
       'error' AS status FROM lineitem
UNION ALL SELECT 'discount below tax', count(*) FILTER (WHERE l_returnflag = 'R' AND l_discount < l_tax), 'warn' FROM lineitem
UNION ALL SELECT 'order key set', 0, 'pass'
UNION ALL SELECT 'order keys unique', 0, 'pass'
UNION ALL SELECT 'lines unique', (SELECT count(*) FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 'error'
UNION ALL SELECT 'as many orders as lines', (SELECT abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM lineitem))), 'warn'
UNION ALL SELECT 'order columns', 2, 'error'
UNION ALL SELECT 'must find something', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'), 'pass'
UNION ALL SELECT 'more lines than orders', (SELECT CASE WHEN o > l THEN o - l WHEN o = l THEN 1 ELSE 0 END FROM
  (SELECT count(*) AS o FROM orders), (SELECT count(*) AS l FROM lineitem)), 'pass'
UNION ALL SELECT 'a price', 0, 'pass'
UNION ALL SELECT 'one flag', (SELECT CASE WHEN min(l_returnflag) = max(l_returnflag) THEN 1 ELSE 0 END FROM lineitem), 'pass'
UNION ALL SELECT 'open orders', (SELECT CASE WHEN count(nullif(o_orderstatus, 'O')) / count(*) < 0.9 THEN 1 ELSE 0 END FROM orders), 'warn'
UNION ALL SELECT 'orders of late', 1, 'error'
""")
def qc_suite(t):
    lines, orders = t.lineitem, t.orders
    return run_checks([
        RowCheck("quantity in range", lines, q.range_violation("l_quantity", 1, 45)),
        RowCheck("discount below tax", lines, q.expression_violation("l_discount >= l_tax"), where="l_returnflag = 'R'",
                 rating=Rating(severity="warn")),
        RowCheck("order key set", orders, F.col("o_orderkey").isNull()),
        TableCheck("order keys unique", q.unique(orders, "o_orderkey")),
        TableCheck("lines unique", q.unique_combination_of_columns(lines, ["l_orderkey", "l_linenumber"])),
        equal_rowcount_check("as many orders as lines", orders, lines, Rating(error_if="< 0", warn_if="> 0")),
        TableCheck("order columns", q.columns_match_set(
            orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_priority"])),
        TableCheck("must find something", q.assert_equal(orders.where("o_orderstatus = 'P'"), "o_orderstatus", F.lit("F")),
                   rating=Rating(error_if="< 1", warn_if="< 1")),
        fewer_rows_check("more lines than orders", t.orders, t.lineitem),
        at_least_one_check("a price", orders, "o_totalprice"),
        not_constant_check("one flag", t.lineitem, "l_returnflag"),
        not_null_proportion_check("open orders", orders, F.nullif("o_orderstatus", F.lit("O")), 0.9,
                                  rating=Rating(severity="warn")),
        recency_check("orders of late", orders, "o_orderdate", "day", 1, now=datetime(2024, 1, 1)),
    ])
