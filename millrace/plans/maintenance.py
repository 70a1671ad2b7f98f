"""Keeping lake tables in shape: merging small files, finding files no longer in use."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import quoted
from millrace.functions.hashes import row_hash
from millrace.literals import moment
from millrace.operators.relations import differences
from millrace.session import stage
from millrace.sinks.tables import balanced
from millrace.sources.tables import DEFAULT_FORMAT, read_table

RETENTION_HOURS = 168
TARGET_FILE_BYTES = 256 * 1024 * 1024

# A folder named 01 must not be rewritten as 1.
TEXT_FOLDERS = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def file_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """Files below the paths: path, modificationTime, length. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(list(paths)).select("path", "modificationTime", "length")


def content_checksum(df: DataFrame) -> DataFrame:
    """Row count and an order-free checksum: one scan, no shuffle of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row_hash(df, sorted(df.columns)).cast("decimal(38,0)")).alias("checksum"))


def same_content(a: DataFrame, b: DataFrame, exact: bool = False) -> bool:
    """Whether two tables hold the same rows equally often. ``exact`` compares the rows themselves."""
    if exact:
        return differences(a, b, multiset=True).isEmpty()  # not by buckets, whose checksums are no proof
    return content_checksum(a).first() == content_checksum(b).first()


def _own_session(spark: SparkSession, values: dict[str, str]) -> SparkSession:
    """A session of the same application with its own settings, so that no other query plans with them."""
    own = spark.newSession()
    for name, value in values.items():
        own.conf.set(name, value)
    return own


def _files_of(target_bytes: int, partitioned: bool) -> dict[str, str]:
    """Settings under which a rewrite makes files of about the target size."""
    if partitioned:
        return {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}
    # The scan itself packs small files into tasks of that size, and each task writes one file.
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }


def compact(spark: SparkSession, path: str, new_path: str, partition_columns: list[str] | None = None,
            fmt: str = DEFAULT_FORMAT, target_bytes: int = TARGET_FILE_BYTES, exact_check: bool = False) -> DataFrame:
    """Rewrite a table as fewer, larger files in a new folder, and check that its content is the same.

    Without partition columns no row is shuffled. The old folder is left as it is; readers switch
    when they like. A Delta table is compacted in place by Delta itself.
    """
    if fmt == "delta":
        from delta.tables import DeltaTable

        DeltaTable.forPath(spark, path).optimize().executeCompaction()
        return read_table(spark, path, fmt)
    own = _own_session(spark, TEXT_FOLDERS | _files_of(target_bytes, bool(partition_columns)))
    table = read_table(own, path, fmt)
    content_checksum(table)  # a type that cannot be compared shows before the rewrite
    if partition_columns:
        balanced(table, *partition_columns).write.format(fmt).partitionBy(*partition_columns).save(new_path)
    else:
        table.write.format(fmt).save(new_path)
    if not same_content(table, read_table(own, new_path, fmt), exact_check):
        raise RuntimeError(f"{new_path} does not hold the rows of {path}")
    return read_table(spark, new_path, fmt)


#: Where a compacted version lists its files, and the size below which a file is small, as a share of the target.
LIVE_FILES, SMALL_SHARE = "_live", 0.75


def _bins(files: DataFrame, target_bytes: int, small_bytes: int) -> DataFrame:
    """Small files with the number of the bin they are merged in: ``path``, ``bin``, counted from 0 over all folders.

    Files of one folder are taken by rising size, and a bin is full when it reaches the target. A bin of one file
    is none. Only names and sizes are looked at.
    """
    small = files.where(F.col("length") < small_bytes).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    along = Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("length").over(along), F.lit(0))
    binned = small.withColumn("place", F.floor(filled / F.lit(target_bytes)))
    crowded = binned.groupBy("folder", "place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    numbered = crowded.withColumn("bin", (F.row_number().over(Window.orderBy("folder", "place")) - 1).cast("int"))
    return binned.join(numbered, ["folder", "place"]).select("path", "bin")


def compact_small(spark: SparkSession, path: str, new_path: str, partition_columns: list[str] | None = None,
                  fmt: str = DEFAULT_FORMAT, target_bytes: int = TARGET_FILE_BYTES, small_bytes: int | None = None,
                  exact_check: bool = False) -> DataFrame:
    """Merge the small files of a table, folder by folder, and leave the large ones as they are.

    Files of less than ``small_bytes`` (three quarters of the target) are packed into bins of about the target's
    size; each bin is read, sent to one task and written as one file below ``new_path``. All other files stay where
    they are, by name and time, and are not read. The new version is the list of its files in
    ``new_path/_live``, which ``read_live`` reads; the old folder stays as it is, so readers switch when they like,
    and ``stale_files`` finds what no version lists. The rows of the merged files are checked.
    """
    own = _own_session(spark, TEXT_FOLDERS)
    schema = read_table(own, path, fmt).schema
    files = stage(file_listing(own, path), "files")
    bins = stage(_bins(files, target_bytes, int(SMALL_SHARE * target_bytes) if small_bytes is None else small_bytes), "bins")
    count = (bins.agg(F.max("bin")).first()[0] or 0) + 1
    crowded = not bins.isEmpty()
    if crowded:
        # One row per small file; what is read of them goes to the driver's list of paths, as every scan's does.
        paths = [r.path for r in bins.select("path").collect()]
        rows = own.read.format(fmt).schema(schema).option("basePath", path).load(paths)
        content_checksum(rows)  # a type that cannot be compared shows before the rewrite
        placed = rows.withColumn("__file", F.col("_metadata.file_path")).join(bins.withColumnRenamed("path", "__file"), "__file")
        binned = placed.repartitionById(count, F.col("bin")).select([quoted(f.name) for f in schema.fields])
        binned.write.format(fmt).partitionBy(*(partition_columns or [])).save(new_path)
        if not same_content(rows, own.read.format(fmt).schema(schema).load(new_path), exact_check):
            raise RuntimeError(f"{new_path} does not hold the rows of the small files of {path}")
    left = files.join(bins, "path", "left_anti").select("path", F.lit(path).alias("root"))
    if crowded:
        left = left.union(file_listing(own, new_path).where(~F.col("path").contains("/_")).select("path", F.lit(new_path).alias("root")))
    left.write.parquet(f"{new_path}/{LIVE_FILES}")
    return read_live(spark, new_path, schema, fmt)


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of the files of a compacted version, and the ``root`` folder each lies below."""
    return spark.read.parquet(f"{path}/{LIVE_FILES}")


def read_live(spark: SparkSession, path: str, schema: StructType, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The table that a compacted version lists."""
    own = _own_session(spark, TEXT_FOLDERS)
    paths: dict[str, list[str]] = {}
    for row in live_files(own, path).collect():
        paths.setdefault(row.root, []).append(row.path)
    parts = [spark.read.format(fmt).schema(schema).option("basePath", root).load(found) for root, found in sorted(paths.items())]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def stale_files(spark: SparkSession, root: str, live_paths: list[str], now: datetime | Column | None = None,
                retention_hours: int = RETENTION_HOURS) -> DataFrame:
    """Files below ``root`` that no live path holds and that are older than the retention.

    Lists only; nothing is deleted.
    """
    present = F.current_timestamp() if now is None else moment(now)
    oldest_kept = F.timestamp_add("hour", F.lit(-retention_hours), present)
    live = file_listing(spark, *live_paths).select("path")
    return file_listing(spark, root).where(F.col("modificationTime") < oldest_kept).join(live, "path", "left_anti")
