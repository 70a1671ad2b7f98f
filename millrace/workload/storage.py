"""Files, tables and streams: written, read back, compared with what went in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.plans.incremental import newer_than_any
from millrace.plans.maintenance import compact, compact_small, file_listing, stale_files
from millrace.session import new_path
from millrace.sinks import append_partitioned, as_table, as_view, overwrite, write_incremental
from millrace.sinks.tables import balanced
from millrace.sources.feed import ENVELOPE
from millrace.sources.seeds import read_large_seed
from millrace.sources.tables import Source, read_json, read_table, refresh
from millrace.streaming.ingest import append_stream, ingest, open_files, without_repeats
from millrace.workload.registry import Tables, query

RECORD = "event_id bigint, event_type string, user_id bigint, value double"
#: Rows of a table for each set of small files that ``compact_selective`` writes.
ROWS_A_SLIVER = 1_000_000


def envelope(events: DataFrame) -> DataFrame:
    """Events as messages of a topic. Error events carry text that is no record."""
    record = F.to_json(F.struct("event_id", "event_type", "user_id", "value"))
    values = {
        "key": F.col("event_id").cast("string").cast("binary"),
        "value": F.when(F.col("event_type") == "error", "not a record").otherwise(record).cast("binary"),
        "topic": F.lit("events"),
        "partition": (F.col("event_id") % 8).cast("int"),
        "offset": F.col("event_id"),
        "timestamp": F.col("ts").cast("timestamp"),
        "timestampType": F.lit(0),
    }
    return events.select([values[f.name].alias(f.name) for f in ENVELOPE.fields])


DECODED = """
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN value END AS value
FROM events
"""


def _record_schema(t: Tables):
    return t.spark.createDataFrame([], RECORD).schema


@query("stream_ingest", DECODED)
def stream_ingest(t):
    """Topic to lake table; unreadable messages become rows of NULLs."""
    topic, path, checkpoint = (new_path(t.spark, name) for name in ("topic", "ingested", "checkpoint"))
    overwrite(envelope(t.events), topic)
    ingest(open_files(t.spark, topic), path, checkpoint, _record_schema(t), until_caught_up=True).awaitTermination()
    return read_table(t.spark, path, merge_schema=True)


@query("stream_restart", DECODED)
def stream_restart(t):
    """Three runs with one checkpoint: half the topic, the rest of it, nothing new."""
    topic, path, checkpoint = (new_path(t.spark, name) for name in ("topic", "ingested", "checkpoint"))
    messages = envelope(t.events)
    halves = [messages.where(F.col("partition") < 4), messages.where(F.col("partition") >= 4), None]
    for arriving in halves:
        if arriving is not None:
            arriving.write.mode("append").parquet(topic)
        run = ingest(open_files(t.spark, topic, files_per_batch=1000), path, checkpoint, _record_schema(t),
                     until_caught_up=True)
        run.awaitTermination()
    return read_table(t.spark, path)


@query("stream_dedup", DECODED)
def stream_dedup(t):
    """A topic that delivers twice, in two runs with one checkpoint: the second also repeats what the first has seen."""
    topic, path, checkpoint = (new_path(t.spark, name) for name in ("topic", "ingested", "checkpoint"))
    messages = envelope(t.events)
    early, late = messages.where(F.col("partition") < 4), messages.where(F.col("partition") >= 4)
    for arriving in (early.unionAll(early), late.unionAll(early).unionAll(late)):
        arriving.write.mode("append").parquet(topic)
        once = without_repeats(open_files(t.spark, topic), ["key"], "timestamp", "60 days")
        ingest(once, path, checkpoint, _record_schema(t), until_caught_up=True).awaitTermination()
    return read_table(t.spark, path)


@query("stream_files", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_files(t):
    """The table's own files, followed as a stream."""
    path, checkpoint = (new_path(t.spark, name) for name in ("followed", "checkpoint"))
    rows = open_files(t.spark, f"{t.folder}/events.*", t.events.schema)
    append_stream(rows, path, checkpoint, until_caught_up=True).awaitTermination()
    return read_table(t.spark, path)


@query("sink_partitioned", "SELECT event_id, user_id, value, event_type FROM events")
def sink_partitioned(t):
    path = new_path(t.spark, "partitioned")
    rows = t.events.select("event_id", "event_type", "user_id", "value")
    append_partitioned(rows.where("user_id <= 50"), path, ["event_type"])
    append_partitioned(rows.where("user_id > 50"), path, ["event_type"])
    refresh(t.spark, path)
    return read_table(t.spark, path)


@query("sink_overwrite", "SELECT p_partkey, p_brand, p_size FROM part")
def sink_overwrite(t):
    path = new_path(t.spark, "overwritten")
    rows = t.part.select("p_partkey", "p_brand", "p_size")
    overwrite(rows.where("p_size > 10"), path)
    overwrite(rows, path)
    refresh(t.spark, path)
    return read_table(t.spark, path)


@query("sink_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def sink_table(t):
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return as_table(rows, "millrace_supplier", new_path(t.spark, "table"))


@query("sink_view", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def sink_view(t):
    """A declared source, a view on it, a view on the view."""
    Source(t.spark, t.folder, ("customer",)).register()
    funded = as_view(t.spark.table("customer").where("c_acctbal > 0"), "millrace_funded")
    return funded.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("sink_incremental", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
   OR o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
""")
def sink_incremental(t):
    """First run with the early orders, second with all of them, third with nothing new."""
    path = new_path(t.spark, "model")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    early = orders.where("o_orderdate < timestamp_ntz'1998-01-01 00:00:00'")

    def model_of(source: DataFrame):
        return lambda standing: source if standing is None else newer_than_any(source, standing, ["o_orderdate"])

    for source in (early, orders):
        write_incremental(t.spark, path, model_of(source))
    return write_incremental(t.spark, path, model_of(orders))


@query("json_infer", """
SELECT event_id, event_type, user_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events
""")
def json_infer(t):
    """Nested JSON text, landed and read back with the schema found in it."""
    path = new_path(t.spark, "landed")
    user = F.struct(F.col("user_id").alias("id"), F.from_json("props", "k bigint").alias("props"))
    t.events.select("event_id", "event_type", user.alias("user")).write.json(path)
    landed = read_json(t.spark, path)
    return landed.select("event_id", "event_type", F.col("user.id").alias("user_id"), F.col("user.props.k").alias("k"))


@query("csv_seed", "SELECT doc_id, nullif(text, '') AS text, lang, n_chars FROM documents")
def csv_seed(t):
    """Texts with commas, quotes and line breaks, read by several tasks a file."""
    path = new_path(t.spark, "seed")
    seed = t.documents.select("doc_id", "text", "lang", "n_chars")  # a file for each task of the scan, however many these are
    as_is = {"header": "true", "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    seed.write.options(**as_is).csv(path)
    return read_large_seed(t.spark, path, seed.schema, split_bytes=1 << 19)


@query("json_documents", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderpriority FROM orders
""")
def json_documents(t):
    """Documents spread over several lines, in arrays of a thousand, one array to a file."""
    path = new_path(t.spark, "documents")
    document = F.struct("o_orderkey", "o_orderstatus", F.struct("o_custkey", "o_orderpriority").alias("customer"))
    block = F.floor(F.col("o_orderkey") / 4_000).cast("int")  # a quarter of the numbers are in use
    pretty = t.orders.select(block.alias("block"), F.to_json(document, {"pretty": "true"}).alias("one"))
    arrays = pretty.groupBy("block").agg(F.concat(F.lit("["), F.array_join(F.collect_list("one"), ","), F.lit("]")).alias("value"))
    arrays.write.partitionBy("block").text(path)
    read = read_json(t.spark, path, multi_line=True)
    return read.select("o_orderkey", "o_orderstatus", F.col("customer.o_custkey").alias("o_custkey"),
                       F.col("customer.o_orderpriority").alias("o_orderpriority"))


@query("compact", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def compacted(t):
    """Many small files made into few."""
    small, merged = new_path(t.spark, "small"), new_path(t.spark, "merged")
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"]
    t.lineitem.select(columns).repartition(40).write.parquet(small)
    return compact(t.spark, small, merged)


@query("compact_partitioned", "SELECT event_id, ts, user_id, value, event_type FROM events")
def compact_partitioned(t):
    small, merged = new_path(t.spark, "small"), new_path(t.spark, "merged")
    rows = t.events.select("event_id", "ts", "user_id", "value", "event_type")
    rows.repartition(16).write.partitionBy("event_type").parquet(small)
    return compact(t.spark, small, merged, ["event_type"], exact_check=True)


@query("compact_selective", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def compact_selective(t):
    """Per folder large files and many small ones, of which only the small ones are rewritten.

    A larger table has more files of either kind, not larger ones.
    """
    mixed, merged = new_path(t.spark, "mixed"), new_path(t.spark, "merged")
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    old = F.pmod(F.col("l_orderkey"), F.lit(4)) > 0
    slivers = max(16, rows.count() // ROWS_A_SLIVER)
    balanced(rows.where(old), "l_returnflag").write.partitionBy("l_returnflag").parquet(mixed)
    rows.where(~old).repartition(slivers).write.mode("append").partitionBy("l_returnflag").parquet(mixed)
    largest = file_listing(t.spark, mixed).agg(F.max("length")).first()[0]
    return compact_small(t.spark, mixed, merged, ["l_returnflag"], target_bytes=largest, small_bytes=largest // 4)


@query("stale_files", "SELECT DISTINCT event_type FROM events")
def stale(t):
    """A table compacted into a new version: every folder of the old version holds stale files."""
    root = new_path(t.spark, "versions")
    rows = t.events.select("event_id", "value", "event_type")
    append_partitioned(rows, f"{root}/v1", ["event_type"])
    compact(t.spark, f"{root}/v1", f"{root}/v2", ["event_type"])
    later = F.timestamp_add("day", F.lit(8), F.current_timestamp())
    found = stale_files(t.spark, root, [f"{root}/v2"], now=later)
    return found.select(F.regexp_extract("path", "event_type=([^/]+)", 1).alias("event_type")).distinct()
