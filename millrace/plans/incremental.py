"""Loading only what is new."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.columns import as_list, quoted
from millrace.functions.hashes import same_to_grouping_and_hash
from millrace.literals import constants
from millrace.plans.kept import Kept, summary_of, summary_parts
from millrace.session import stage
from millrace.sinks.tables import balanced
from millrace.sources.tables import DEFAULT_FORMAT, read_table, read_table_if_exists, refresh

# Fixed value: stands in for a NULL high-water mark.
EARLIEST = "1900-01-01"


def _stamp(name: str, compare_as: str | None) -> Column:
    return quoted(name) if compare_as is None else quoted(name).try_cast(compare_as)


def high_water_marks(target: DataFrame, keys: list[str], stamp: str, compare_as: str | None = None) -> DataFrame:
    """Greatest ``stamp`` per key, in ``__mark``."""
    return target.groupBy(*[quoted(k) for k in keys]).agg(F.max(_stamp(stamp, compare_as)).alias("__mark"))


def newer_than_target(staged: DataFrame, target: DataFrame | None, keys: list[str], stamp: str,
                      new_keys: str = "drop", compare_as: str | None = None) -> DataFrame:
    """Staged rows whose ``stamp`` is greater than the greatest one the target has for their key.

    Keys the target does not have are dropped or kept, as ``new_keys`` says. A missing target has no
    keys: with "drop" nothing could ever be loaded, so that is an error; start a table with "keep". Equal staged rows all pass. Stamps held as text compare as text, so they must be
    year-first and zero-padded; ``compare_as="timestamp"`` compares the times they stand for, and
    text that is no time is never newer.

    With "drop" a NULL in a key matches nothing. With "keep" NULL equals NULL, so that a second run
    does not load the same rows again.
    """
    if new_keys not in ("drop", "keep"):
        raise ValueError(f"new_keys must be drop or keep, got {new_keys!r}")
    if target is None:
        if new_keys == "drop":
            raise ValueError('the target does not exist; new_keys="keep" makes the first load')
        return staged
    marks = high_water_marks(target, keys, stamp, compare_as)
    if new_keys == "keep":
        return newer_than_marks(staged, marks, keys, stamp, new_keys, compare_as)
    # The marks are needed twice, and reading the target is the expensive part.
    marks = stage(marks, "marks")
    # No row at or below the smallest mark can pass.
    oldest = constants(marks.agg(F.min("__mark").alias("oldest")))["oldest"]
    return newer_than_marks(staged.where(_stamp(stamp, compare_as) > oldest), marks, keys, stamp, new_keys, compare_as)


def newer_than_marks(staged: DataFrame, marks: DataFrame, keys: list[str], stamp: str, new_keys: str = "drop",
                     compare_as: str | None = None) -> DataFrame:
    """``newer_than_target`` where the greatest stamp per key is known, in ``__mark``."""
    newer = _stamp(stamp, compare_as) > F.col("__mark")
    if new_keys == "keep":
        known, on = _for_join(marks, keys, Column.eqNullSafe)
        found = staged.join(known, on, "left").where(F.col("__known").isNull() | newer)
    else:
        known, on = _for_join(marks, keys, operator.eq)
        found = staged.join(known, on, "inner").where(newer)
    return found.select([quoted(c) for c in staged.columns])


@dataclass(frozen=True)
class Loads:
    """A table loaded in numbered loads, whose marks, and a summary if wanted, are kept beside it.

    A load reads its own rows and the kept marks of their keys, never the table. Its rows go to a folder of their
    own (``__load=<number>``), so a load that is repeated with the same rows after a failure replaces what it wrote,
    and gives the same table. Loads are numbered upwards; ``fold_after`` bounds how many folders of marks are read.
    """

    path: str
    marks: Kept
    stamp: str
    partition_columns: tuple[str, ...] = ()
    new_keys: str = "drop"
    compare_as: str | None = None
    summary: Kept | None = None
    averages: tuple[str, ...] = ()
    fold_after: int = 24
    fmt: str = DEFAULT_FORMAT

    def load(self, rows: DataFrame, number: int, new_keys: str | None = None) -> DataFrame:
        """Adds the rows that are newer than the mark their key had before this load; returns them as written."""
        spark, keys = rows.sparkSession, list(self.marks.keys)
        how = new_keys or self.new_keys
        known = self.marks.current(number, only=rows)
        if known is not None:
            fresh = newer_than_marks(rows, known, keys, self.stamp, how, self.compare_as)
        else:
            fresh = rows if how == "keep" else rows.limit(0)  # no key is known
        folder = f"{self.path}/__load={number}"
        writer = balanced(fresh, *self.partition_columns).write.format(self.fmt).mode("overwrite")
        writer.partitionBy(*self.partition_columns).save(folder)
        refresh(spark, self.path)
        written = read_table(spark, folder, self.fmt, schema=rows.schema)
        mark = _stamp(self.stamp, self.compare_as).alias("__mark")
        self.marks.put(number, written.select(*[quoted(k) for k in keys], mark))
        self.marks.fold(number, self.fold_after)
        if self.summary is not None:
            self.summary.put(number, summary_parts(written, list(self.summary.keys), list(self.averages), self.stamp))
            self.summary.fold(number, self.fold_after)
        return written

    def table(self, spark: SparkSession, schema=None) -> DataFrame:
        """All rows loaded so far."""
        return read_table(spark, self.path, self.fmt, schema=schema).drop("__load")

    def summarised(self) -> DataFrame:
        """The summary of all rows loaded so far, from what was kept with each load."""
        assert self.summary is not None
        return summary_of(self.summary.current(), list(self.summary.keys), list(self.averages), self.stamp)


def _for_join(marks: DataFrame, keys: list[str], same) -> tuple[DataFrame, Column]:
    known = marks.select(*[quoted(k).alias(f"__{k}") for k in keys], "__mark", F.lit(True).alias("__known"))
    return known, reduce(operator.and_, [same(quoted(k), quoted(f"__{k}")) for k in keys])


def newer_than_any(df: DataFrame, target: DataFrame, fields) -> DataFrame:
    """Rows in which any of the fields exceeds that field's greatest value in the target.

    An empty target has no greatest value, so nothing passes. For dates, times and texts a NULL in the
    target counts as the earliest value; for other types it does not count.
    """
    fields = as_list(fields)

    def counted(name: str) -> Column:
        kind = target.schema[name].dataType
        if kind.typeName() in ("date", "timestamp", "timestamp_ntz") or kind.simpleString().startswith("string"):
            return F.coalesce(quoted(name), F.lit(EARLIEST).cast(kind))
        return quoted(name)

    marks = constants(target.agg(*[F.max(counted(name)).alias(name) for name in fields]))
    return df.where(reduce(operator.or_, [quoted(name) > marks[name] for name in fields]))


def current_rows(source: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Rows that carry their key's greatest ``stamp``; ties are all kept.

    Rows with a NULL in the key or the stamp are never current. The join key includes the stamp, so
    the older rows of a hot key spread over all tasks.
    """
    latest = source.groupBy(*[quoted(k).alias(f"__{k}") for k in keys]).agg(F.max(quoted(stamp)).alias("__stamp"))
    on = reduce(operator.and_, [quoted(k) == quoted(f"__{k}") for k in keys], quoted(stamp) == F.col("__stamp"))
    return source.join(latest, on, "inner").select([quoted(c) for c in source.columns])


@dataclass(frozen=True)
class CurrentRows:
    """The current rows of a source, kept in buckets of keys; a delta rewrites the buckets of its keys only.

    Every merge writes the buckets it touches into a folder of its own number, and the latest folder of a bucket
    counts. Buckets without new rows are neither read nor written. A merge that is repeated after a failure
    reads what stood before it and replaces what it wrote. Ties and NULLs are treated as ``current_rows`` does.
    """

    path: str
    keys: tuple[str, ...]
    stamp: str
    buckets: int = 64
    fmt: str = DEFAULT_FORMAT

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[quoted(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def versions(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The latest merge of each bucket, from the names of folders; there are no more entries than buckets."""
        names = read_table_if_exists(spark, self.path, self.fmt)
        if names is None:
            return {}
        numbers = names.select(F.col("__merge").cast("int").alias("merge"), F.col("__bucket").cast("int").alias("bucket")).distinct()
        known = numbers if before is None else numbers.where(F.col("merge") < before)
        return {r.bucket: r.merge for r in known.groupBy("bucket").agg(F.max("merge").alias("merge")).collect()}

    def rows(self, spark: SparkSession, schema, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """Current rows as they stood before a merge, of some buckets if ``only`` names them; None if there are none."""
        latest = self.versions(spark, before)
        paths = [f"{self.path}/__merge={m}/__bucket={b}" for b, m in sorted(latest.items()) if only is None or b in only]
        return spark.read.format(self.fmt).schema(schema).load(paths) if paths else None

    def merge(self, delta: DataFrame, number: int) -> list[int]:
        """Takes new rows in; returns the buckets they touched."""
        if not same_to_grouping_and_hash(delta, list(self.keys)):
            raise ValueError("keys with collated texts cannot be dealt into buckets")
        spark, columns = delta.sparkSession, [quoted(c) for c in delta.columns]
        touched = sorted(r.bucket for r in delta.select(self._bucket().alias("bucket")).distinct().collect())
        standing = self.rows(spark, delta.schema, number, touched)
        every = delta if standing is None else standing.select(columns).unionAll(delta)
        current = current_rows(every, list(self.keys), self.stamp).withColumn("__bucket", self._bucket())
        balanced(current, "__bucket").write.format(self.fmt).mode("overwrite").partitionBy("__bucket").save(f"{self.path}/__merge={number}")
        refresh(spark, self.path)
        return touched
