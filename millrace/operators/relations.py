"""Whole-table operators: union, deduplication, differences, value lists."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from millrace.functions.columns import as_column, as_list, named, ordering, quoted, sort_keys
from millrace.functions.hashes import row_hash, same_to_grouping_and_hash
from millrace.session import shuffle_partitions, stage

# Fixed value: name of the column that tells which relation a row of a union came from.
SOURCE_COLUMN = "_dbt_source_relation"

# A counted row is repeated in blocks of 2 ** BLOCK_BITS copies.
BLOCK_BITS = 20


def union_relations(relations: Mapping[str, DataFrame], column_override: Mapping[str, str] | None = None,
                    include: Iterable[str] = (), exclude: Iterable[str] = (),
                    source_column: str | None = SOURCE_COLUMN, where: str | Column | None = None) -> DataFrame:
    """All rows of all relations over the columns of any of them.

    Columns come in first-seen order and spelling, with the type of their first relation or of
    ``column_override``; a relation without the column gives NULL. Letter case makes no difference
    unless the session says so, and an override of a column that does not exist is an error. ``where`` filters each input
    and may use columns that are not in the result.
    """
    include, exclude = ({n.lower() for n in names} for names in (include, exclude))
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    first = next(iter(relations.values()), None)
    exact = first is not None and first.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def key(name: str) -> str:
        return name if exact else name.lower()

    names: dict[str, str] = {}
    types: dict[str, DataType | str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            name = field.name.lower()
            if name not in exclude and (not include or name in include):
                names.setdefault(key(field.name), field.name)
                types.setdefault(key(field.name), field.dataType)
    if not types:
        raise ValueError(f"no columns to union in {list(relations)}")
    for name, to in (column_override or {}).items():
        if key(name) not in types:
            raise ValueError(f"column_override names {name!r}, which no relation has")
        types[key(name)] = to

    def aligned(label: str, df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        own = {key(c): c for c in df.columns}
        columns = [(quoted(own[n]) if n in own else F.lit(None)).cast(t).alias(names[n]) for n, t in types.items()]
        source = [] if source_column is None else [F.lit(label).alias(source_column)]
        return rows.select(*source, *columns)

    return reduce(DataFrame.unionAll, [aligned(label, df) for label, df in relations.items()])


def deduplicate(df: DataFrame, partition_by, order_by) -> DataFrame:
    """The first row of every partition; rows with NULLs are kept like any other.

    Give a total order, or the choice among ties is arbitrary. Where the sort keys are texts and
    all go the same way, the first row is a minimum or maximum: each task sorts its rows by partition
    and keeps one row of each, before the shuffle and after it. Otherwise Spark ranks the rows and drops
    all but one per partition and task before the shuffle. Either way a hot partition costs no more
    than a cold one.
    """
    items = as_list(order_by)
    if not any(isinstance(item, Column) for item in items):
        keys = sort_keys(items)
        if len({key.descending for key in keys}) == 1:
            best = F.max_by if keys[0].descending else F.min_by
            return _one_per_key(df, partition_by, best, [c for key in keys for c in key.comparable()])
    window = Window.partitionBy(*[named(df, p) for p in as_list(partition_by)]).orderBy(*ordering(items))
    return df.withColumn("__row", F.row_number().over(window)).where(F.col("__row") == 1).drop("__row")


def latest_per_key(df: DataFrame, partition_by, latest_by) -> DataFrame:
    """The row with the greatest ``latest_by`` per partition. NULL counts as the smallest value."""
    return _one_per_key(df, partition_by, F.max_by, [named(df, c) for c in as_list(latest_by)])


def _one_per_key(df: DataFrame, partition_by, best, compared: list[Column]) -> DataFrame:
    keys = [named(df, p).alias(f"__key{i}") for i, p in enumerate(as_list(partition_by))]
    row = best(F.struct(*[quoted(c) for c in df.columns]), F.struct(*compared)).alias("__row")
    return df.groupBy(*keys).agg(row).select("__row.*")


def column_values(df: DataFrame, column, order_by="count(*) desc", max_records: int | None = None,
                  where: str | Column | None = None) -> DataFrame:
    """Distinct values in ``value``, by default the most frequent first; NULL is a value.

    ``order_by`` holds aggregates, such as ``"max(ts) desc"``. Equal ranks come in order of the value.
    """
    rows = df if where is None else df.where(where)
    keys = sort_keys(order_by)
    ranks = [key.column.alias(f"__rank{i}") for i, key in enumerate(keys)]
    counted = rows.groupBy(as_column(column).alias("value")).agg(*ranks)
    order = [key.sorted(F.col(f"__rank{i}")) for i, key in enumerate(keys)]
    ranked = counted.orderBy(*order, F.col("value").asc_nulls_last())
    return (ranked if max_records is None else ranked.limit(max_records)).select("value")


#: Values that a list for naming columns may have, unless the caller says otherwise.
MOST_VALUES = 10_000


def top_values(df: DataFrame, column, most: int, where: str | Column | None = None, tracked: int = 1 << 16) -> DataFrame:
    """The ``most`` most frequent values in ``value``, exactly; NULL is a value, equal counts come in order of the value.

    A mergeable sketch of frequent items names candidates in one scan, which are then counted exactly, so only
    they are shuffled. The sketch bounds how often any other value can occur; where the last candidate does not
    exceed that bound, all values are counted. ``tracked`` is how many values the sketch keeps.
    """
    rows = (df if where is None else df.where(where)).select(as_column(column).alias("value"))
    order = [F.col("n").desc(), F.col("value").asc_nulls_last()]
    if same_to_grouping_and_hash(rows, ["value"]):
        asked = min(tracked, 4 * most + 100)
        key = row_hash(rows, ["value"])
        sketch = F.call_function("approx_top_k", key, F.lit(asked), F.lit(tracked))
        found = rows.agg(F.count(F.lit(1)).alias("total"), sketch.alias("items")).first()
        items = found["items"] or []
        # The sketch's table has a power of two of places, at least 4/3 of what it tracks; its counts are off by 3.5 / places at most.
        error = 3.5 / (1 << math.ceil(math.log2(tracked / 0.75))) * found.total
        bound = max(2 * error, items[-1]["count"] + error if len(items) == asked else 0)
        counted = rows.where(key.isin([i.item for i in items])).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        best = stage(counted.orderBy(*order).limit(most), "top")
        if best.where(F.col("n") > bound).count() == most:
            return best.orderBy(*order).select("value")
    return column_values(df, column, max_records=most, where=where)


def column_value_list(df: DataFrame | None, column, default: list | None = None, most: int | None = MOST_VALUES,
                      **options) -> list:
    """``column_values`` as a Python list, for naming pivot columns.

    ``default`` stands in for a missing table or an empty result. The list is collected to the driver; more
    values than ``most`` are an error, not a shortened list.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    values = column_values(df, column, **options)
    found = [r["value"] for r in (values if most is None else values.limit(most + 1)).collect()]
    if most is not None and len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return found or (default if default is not None else [])


def single_value(query: DataFrame, default=None, name: str = "value") -> DataFrame:
    """First column of the first row as a one-row frame; ``default`` only where there is no row."""
    first = query.select(quoted(query.columns[0]).alias("__value")).limit(1)
    seen = first.agg(F.count(F.lit(1)).alias("__rows"), F.first("__value").alias("__value"))
    return seen.select(F.when(F.col("__rows") == 0, F.lit(default)).otherwise(F.col("__value")).alias(name))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its count says. Large counts are cut into blocks, and adaptive execution
    spreads the blocks over as many tasks as they need."""
    last_block = F.shiftright(F.col(copies) - 1, BLOCK_BITS)
    blocks = df.where(F.col(copies) > 0).withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    spread = blocks.hint("rebalance")
    left = F.col(copies) - F.shiftleft(F.col("__block"), BLOCK_BITS)
    here = F.least(F.lit(1 << BLOCK_BITS), left).cast("int")
    return spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), here))).drop("__copy", "__block", copies)


def differences(a: DataFrame, b: DataFrame, columns: list[str] | None = None, multiset: bool = False,
                label: str = "which_diff") -> DataFrame:
    """Rows of ``a`` that are not in ``b`` and the reverse, labelled ``a_minus_b`` / ``b_minus_a``.

    Both directions come out of one grouping, so each side is read and shuffled once, and equal rows
    collapse before the shuffle. NULLs are equal to each other. Duplicates are ignored unless
    ``multiset``, which returns each surplus copy.
    """
    names = columns or a.columns

    def side_of(df: DataFrame, in_a: int) -> DataFrame:
        flags = (F.lit(n).cast("long").alias(flag) for n, flag in ((in_a, "__a"), (1 - in_a, "__b")))
        return df.select(*[quoted(c) for c in names], *flags)

    merge = F.sum if multiset else F.max
    grouped = side_of(a, 1).unionAll(side_of(b, 0)).groupBy(*[quoted(c) for c in names]).agg(
        merge("__a").alias("__a"), merge("__b").alias("__b"))
    surplus = F.col("__a") - F.col("__b")
    side = F.when(surplus > 0, "a_minus_b").otherwise("b_minus_a").alias(label)
    differing = grouped.where(surplus != 0)
    if not multiset:
        return differing.select(side, *[quoted(c) for c in names])
    return repeat_rows(differing.select(side, *[quoted(c) for c in names], F.abs(surplus).alias("__n")), "__n")


def differences_by_bucket(a: DataFrame, b: DataFrame, columns: list[str] | None = None, multiset: bool = False,
                          label: str = "which_diff", buckets_per_partition: int = 64) -> DataFrame:
    """``differences`` for tables that should be nearly equal: only rows of buckets that differ are shuffled.

    Rows fall into buckets by their hash, and each bucket of either side has a count and two independent 64-bit
    checksums, which every task adds up before anything is sent. Buckets that agree in all three are taken for
    equal; that they are not has a chance of 2^-128 each. Equal tables cost one scan each and no row of theirs
    leaves its task. Tables with collated texts or fractions, where equal values can have several hashes, are
    compared in full.
    """
    names = columns or a.columns
    if not (same_to_grouping_and_hash(a, names) and same_to_grouping_and_hash(b, names)):
        return differences(a, b, names, multiset, label)
    number = buckets_per_partition * shuffle_partitions(a.sparkSession)

    def bucket(df: DataFrame) -> Column:
        return F.pmod(row_hash(df, names), F.lit(number))

    def sums(df: DataFrame, sign: int) -> DataFrame:
        wide = [(F.lit(sign) * row_hash(df, names, seed).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
        return df.select(bucket(df).alias("bucket"), F.lit(sign).cast("long").alias("n"), *wide)

    both = sums(a, 1).unionAll(sums(b, -1)).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "h1", "h2")])
    differing = [r.bucket for r in both.where("n <> 0 or h1 <> 0 or h2 <> 0").select("bucket").collect()]
    left, right = (df.select([quoted(c) for c in names]).where(bucket(df).isin(differing)) for df in (a, b))
    return differences(left, right, names, multiset, label)
