"""CSV files with line breaks inside quotes, read by several tasks a file.

A task that starts in the middle of a file cannot see whether it starts inside quotes, so Spark gives such files to one
task each. Here the files are read as lines, by as many tasks as their size asks for. The quotes of each split are
counted, and the sum over the splits before it tells whether a split starts inside quotes: a doubled quote counts two
and changes nothing. From there the lines of each split are put together to records, one split to a task at most;
what reaches over the edge of a split is joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

#: What a piece of a record is: all of it, its beginning, or what follows a beginning in an earlier split.
WHOLE, CONTINUED, BEGINNING = 0, 1, 2

# How the fields of a seed are written.
FIELD_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def _quotes(line) -> F.Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def read_large_seed(spark: SparkSession, path: str, schema: StructType | str, split_bytes: int | None = None) -> DataFrame:
    """CSV with a header line in every file. An empty field is NULL.

    Fields may stand between double quotes, a doubled quote being one, and may then hold line breaks; elsewhere there
    are no quotes. ``split_bytes`` is how much of a file one task reads (default: the session's setting).
    """
    own = spark.newSession()
    if split_bytes is not None:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        own.conf.set("spark.sql.files.minPartitionNum", "1")
        own.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    text = own.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"),
                        F.monotonically_increasing_id().alias("number"))
    split, at = ["file", "start"], Window.partitionBy("file").orderBy("start")
    lines = lines.withColumn("quotes", _quotes(F.col("line")))
    counted = lines.groupBy(*split).agg(F.sum("quotes").alias("own"))
    before = F.coalesce(F.sum("own").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counted.select(*split, before.alias("opened"))
    # Lines of a split come to its task in order, and are numbered so.
    inside = Window.partitionBy(*split).orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = lines.join(starts, split).withColumn("after", F.col("opened") + F.sum("quotes").over(inside))
    begins = ((F.col("after") - F.col("quotes")) % 2 == 0).cast("int")
    placed = known.withColumn("place", F.sum(begins).over(inside))
    pieces = placed.groupBy(*split, "place").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("number", "line"))), lambda x: x["line"]), "\n").alias("record"),
        F.max("after").alias("after"))
    kind = F.when(F.col("place") == 0, CONTINUED).when(F.col("after") % 2 == 1, BEGINNING).otherwise(WHOLE)
    pieces = pieces.select(*split, "place", kind.alias("kind"), "record")

    whole = pieces.where(F.col("kind") == WHOLE).select("file", "start", "place", "record")
    edges = pieces.where(F.col("kind") != WHOLE)
    along = Window.partitionBy("file").orderBy("start", "kind")  # what is continued stands before what begins
    numbered = edges.withColumn("number", F.count_if(F.col("kind") == BEGINNING).over(along))
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
    joined = numbered.groupBy("file", "number").agg(
        F.min("start").alias("start"), F.min_by("place", F.struct("start", "kind")).alias("place"),
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    records = whole.unionAll(joined.select("file", "start", "place", "record"))
    # The header is the first record of a file; records may end in a carriage return, and the last line may be empty.
    record = F.regexp_replace("record", "\r$", "")
    fields = records.where(((F.col("start") > 0) | (F.col("place") > 1)) & (record != "")).select(
        F.from_csv(record, _ddl(own, schema), FIELD_OPTIONS).alias("row"))
    return fields.select("row.*")


def _ddl(spark: SparkSession, schema: StructType | str) -> str:
    kind = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kind.fields)
