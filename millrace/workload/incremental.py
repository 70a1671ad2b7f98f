"""Incremental loads, published summaries and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.plans.customers import customer_mart, customer_mart_of_kept, kept_customers
from millrace.plans.incremental import Loads, current_rows, newer_than_any, newer_than_target
from millrace.plans.kept import marks, summaries
from millrace.plans.weather import select_nested, summarise
from millrace.session import new_path
from millrace.sinks import append_partitioned
from millrace.sources.feed import decoded
from millrace.sources.tables import read_table, refresh
from millrace.streaming.ingest import load_stream, open_files
from millrace.workload.registry import Tables, query

LOADED = "ts < timestamp_ntz'2024-01-15 00:00:00' and event_type <> 'signup'"
EVENT_KEY = ["event_type", "user_id"]
EVENT_COLUMNS = ["event_id", "event_type", "user_id", "ts", "value"]

MARKS = """
WITH target AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup'),
marks AS (SELECT event_type, user_id, max(ts) AS mark FROM target GROUP BY event_type, user_id)
"""
NEWER_DROP = MARKS + """
SELECT e.event_id, e.event_type, e.user_id, e.ts, e.value
FROM events e JOIN marks m ON e.event_type = m.event_type AND e.user_id = m.user_id
WHERE e.ts > m.mark
"""
NEWER_KEEP = MARKS + """
SELECT e.event_id, e.event_type, e.user_id, e.ts, e.value
FROM events e LEFT JOIN marks m ON e.event_type = m.event_type AND e.user_id = m.user_id
WHERE m.event_type IS NULL OR e.ts > m.mark
"""


def fresh_events(t: Tables, new_keys: str) -> DataFrame:
    staged = t.events.select(EVENT_COLUMNS)
    return newer_than_target(staged, staged.where(LOADED), EVENT_KEY, "ts", new_keys)


@query("inc_newer_drop", NEWER_DROP)
def inc_newer_drop(t):
    return fresh_events(t, "drop")


@query("inc_newer_keep", NEWER_KEEP)
def inc_newer_keep(t):
    return fresh_events(t, "keep")


def event_summary(events: DataFrame) -> DataFrame:
    return rounded(summarise(events, ["event_type"], ["value", "user_id"], "ts"))


def rounded(summary: DataFrame) -> DataFrame:
    return summary.select("event_type", F.round("value", 6).alias("value"), F.round("user_id", 6).alias("user_id"),
                          "number_of_rows", "ts")


SUMMARY = """
SELECT event_type, round(avg(value), 6) AS value, round(avg(user_id), 6) AS user_id,
       count(ts) AS number_of_rows, max(ts) AS ts
FROM {rows} GROUP BY event_type
"""


@query("publish_agg", SUMMARY.format(rows="events"))
def publish_agg(t):
    return event_summary(t.events)


@query("incremental_publish", f"""
WITH target AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup'),
loaded AS (
  SELECT event_id, event_type, user_id, ts, value FROM target
  UNION ALL SELECT * FROM ({NEWER_DROP})
)
{SUMMARY.format(rows='loaded')}
""")
def incremental_publish(t):
    """The whole hourly run: a partitioned table, the rows newer than it appended, its summary."""
    path = new_path(t.spark, "events")
    staged = t.events.select(EVENT_COLUMNS)
    append_partitioned(staged.where(LOADED), path, ["event_type"])
    fresh = newer_than_target(staged, read_table(t.spark, path), EVENT_KEY, "ts")
    append_partitioned(fresh, path, ["event_type"])
    refresh(t.spark, path)
    return event_summary(read_table(t.spark, path))


def _event_loads(t: Tables) -> Loads:
    state = new_path(t.spark, "state")
    return Loads(new_path(t.spark, "events"), marks(t.spark, f"{state}/marks", EVENT_KEY), "ts", ("event_type",), fold_after=2,
                 summary=summaries(t.spark, f"{state}/summary", ["event_type"], ["value", "user_id"], "ts"), averages=("value", "user_id"))


#: Spans of time whose events come together.
SPANS = ["ts < timestamp_ntz'2024-01-12 00:00:00'", "ts >= timestamp_ntz'2024-01-12 00:00:00' and ts < timestamp_ntz'2024-01-20 00:00:00'",
         "ts >= timestamp_ntz'2024-01-20 00:00:00' or ts is null"]


@query("inc_stream_batches", f"""
WITH target AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type <> 'signup'),
marks AS (SELECT event_type, user_id, max(ts) AS mark FROM target GROUP BY event_type, user_id)
SELECT event_id, event_type, user_id, ts, value FROM target
UNION ALL
SELECT e.event_id, e.event_type, e.user_id, e.ts, e.value
FROM events e JOIN marks m ON e.event_type = m.event_type AND e.user_id = m.user_id
WHERE e.ts > m.mark
""")
def inc_stream_batches(t):
    """A stream in three checkpointed runs onto a standing table, the last batch coming twice."""
    topic, checkpoint = new_path(t.spark, "topic"), new_path(t.spark, "checkpoint")
    events, loads = t.events.select(EVENT_COLUMNS), _event_loads(t)
    loads.load(events.where("ts < timestamp_ntz'2024-01-10 00:00:00' and event_type <> 'signup'"), -1, new_keys="keep")
    for span in SPANS:
        events.where(span).write.mode("append").parquet(topic)
        load_stream(open_files(t.spark, topic, events.schema), loads.load, checkpoint, until_caught_up=True).awaitTermination()
    loads.load(events.where(SPANS[-1]), len(SPANS) - 1)
    return loads.table(t.spark).select(EVENT_COLUMNS)


@query("publish_merged", SUMMARY.format(rows="events"))
def publish_merged(t):
    """The summary out of what three loads kept, one of them repeated; the table itself is not read."""
    events, loads = t.events.select(EVENT_COLUMNS), _event_loads(t)
    for number, span in enumerate(SPANS):
        loads.load(events.where(span), number, new_keys="keep")
    loads.load(events.where(SPANS[-1]), len(SPANS) - 1, new_keys="keep")
    return rounded(loads.summarised())


@query("nested_project_filter", """
SELECT event_id, event_type AS kind, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
FROM events WHERE event_type = 'click' OR event_type = 'purchase'
""")
def nested_project_filter(t):
    record = F.struct("event_id", "event_type", decoded(F.col("props"), "k int").alias("props"))
    fields = {"record.event_id": "event_id", "record.event_type": "kind", "record.props.k": "k"}
    flat = select_nested(t.events.select(record.alias("record")), fields)
    return flat.where((F.col("kind") == "click") | (F.col("kind") == "purchase"))


@query("current_row_per_key", """
WITH latest AS (
  SELECT l_suppkey, l_returnflag, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_suppkey, l_returnflag
)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_returnflag, l.l_shipdate, l.l_extendedprice
FROM lineitem l JOIN latest c
  ON l.l_suppkey = c.l_suppkey AND l.l_returnflag = c.l_returnflag AND l.l_shipdate = c.l_shipdate
""")
def current_row_per_key(t):
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice"]
    return current_rows(t.lineitem.select(columns), ["l_suppkey", "l_returnflag"], "l_shipdate")


def people(t: Tables) -> DataFrame:
    """Orders in the shape of a customer source: a two-part name, an update time, an active flag."""
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("first_name"),
        F.col("o_orderpriority").alias("last_name"),
        F.concat_ws("@", F.col("o_custkey").cast("string"), "o_orderstatus").alias("email"),
        F.col("o_orderdate").alias("last_update"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("active"),
    )


MART = """
people AS (
  SELECT CAST(o_custkey AS VARCHAR) AS first_name, o_orderpriority AS last_name, o_orderdate AS last_update,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS active
  FROM orders
),
latest AS (SELECT first_name, last_name, max(last_update) AS last_update FROM people GROUP BY first_name, last_name),
mart AS (
  SELECT md5(p.first_name || '-' || p.last_name) AS customer_sk, p.first_name, p.last_name, p.last_update
  FROM people p JOIN latest c
    ON p.first_name = c.first_name AND p.last_name = c.last_name AND p.last_update = c.last_update
  WHERE p.active = 0
)
"""


@query("customer_mart", f"WITH {MART} SELECT * FROM mart")
def whole_customer_mart(t):
    return customer_mart(people(t))


@query("customer_mart_delta", f"WITH {MART} SELECT * FROM mart")
def customer_mart_delta(t):
    """The mart from current rows that three deliveries were merged into, the last one coming twice."""
    kept, source = kept_customers(new_path(t.spark, "current"), buckets=16), people(t)
    deliveries = ["last_update < timestamp_ntz'1997-01-01 00:00:00'", "last_update >= timestamp_ntz'1999-01-01 00:00:00' or last_update is null",
                  "last_update >= timestamp_ntz'1997-01-01 00:00:00' and last_update < timestamp_ntz'1999-01-01 00:00:00'"]
    for number, part in enumerate([*deliveries, deliveries[-1]]):
        mart = customer_mart_of_kept(kept, source.where(part), min(number, 2))
    return mart


@query("customer_mart_incremental", f"""
WITH {MART},
standing AS (SELECT max(last_update) AS mark FROM mart WHERE last_update < TIMESTAMP '2000-01-01')
SELECT mart.* FROM mart, standing WHERE mart.last_update > standing.mark
""")
def customer_mart_increment(t):
    standing = customer_mart(people(t)).where("last_update < timestamp_ntz'2000-01-01 00:00:00'")
    return customer_mart(people(t), standing)


@query("batch_validation_multi", """
WITH dated AS (
  SELECT o_orderkey, o_orderdate, o_orderdate + to_days(CAST(o_custkey % 60 AS INTEGER)) AS due FROM orders
),
target AS (SELECT max(o_orderdate) AS d, max(due) AS e FROM dated WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT o_orderkey, o_orderdate, due FROM dated, target WHERE o_orderdate > d OR due > e
""")
def batch_validation_multi(t):
    due = F.timestamp_add("day", (F.col("o_custkey") % 60).cast("int"), F.col("o_orderdate"))
    dated = t.orders.select("o_orderkey", "o_orderdate", due.alias("due"))
    target = dated.where("o_orderdate < timestamp_ntz'2000-01-01 00:00:00'")
    return newer_than_any(dated, target, ["o_orderdate", "due"])


@query("batch_validation_numeric", """
WITH target AS (SELECT nullif(o_custkey, 1) AS c, o_totalprice AS p FROM orders WHERE o_orderkey % 7 <> 0 AND o_totalprice < 300000)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey > (SELECT max(c) FROM target) OR o_totalprice > (SELECT max(p) FROM target)
""")
def batch_validation_numeric(t):
    """Numeric high-water columns, one of them with NULLs."""
    target = t.orders.where("o_orderkey % 7 <> 0 and o_totalprice < 300000").select(
        F.nullif("o_custkey", F.lit(1)).alias("o_custkey"), "o_totalprice")
    return newer_than_any(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), target, ["o_custkey", "o_totalprice"])
