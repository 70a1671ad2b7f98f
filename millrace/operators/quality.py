"""Data-quality checks. Each returns the violating rows; an empty result is a pass.

Checks that look at one row at a time are split in two: a predicate (``*_violation``) and the
function that filters by it, so that a suite can evaluate many predicates in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import as_column, as_list, named, quoted
from millrace.functions.dates import add_units
from millrace.functions.text import slug
from millrace.literals import moment
from millrace.operators.neighbours import COPIES, NEXT, with_next
from millrace.operators.relations import differences, differences_by_bucket, repeat_rows

# --- checks of single rows ------------------------------------------------------------------


def expression_violation(expression: str, column: str | None = None) -> Column:
    """A column is an SQL expression or a name; a name with dots or blanks goes between backticks."""
    return ~F.expr(expression if column is None else f"{column} {expression}")


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false. With a column, its name is put before the expression,
    as in ``column="price", expression="> 0"``. NULL passes."""
    if column is not None and column in df.columns:
        column = "`" + column.replace("`", "``") + "`"
    return df.where(expression_violation(expression, column))


def range_violation(column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    value, broken = as_column(column), F.lit(False)
    if min_value is not None:
        low = as_column(min_value)
        broken = broken | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = as_column(max_value)
        broken = broken | ~(value <= high if inclusive else value < high)
    return broken


def accepted_range(df: DataFrame, column, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the range; bounds are numbers or SQL expressions. NULL passes."""
    return df.where(range_violation(named(df, column), min_value, max_value, inclusive))


def empty_string_violation(column, trim_whitespace: bool = True) -> Column:
    text = as_column(column)
    return (F.trim(text) if trim_whitespace else text) == ""


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """The offending values, trimmed if asked to. NULL passes."""
    shown = F.trim(quoted(column)) if trim_whitespace else quoted(column)
    return df.where(empty_string_violation(quoted(column), trim_whitespace)).select(shown.alias(column))


def not_null(df: DataFrame, column) -> DataFrame:
    return df.where(named(df, column).isNull())


def assert_equal(df: DataFrame, actual, expected) -> DataFrame:
    """Rows in which two columns differ. NULL on either side passes."""
    return df.where(named(df, actual) != named(df, expected))


# --- checks of values and groups ------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    counted = df.where(named(df, column).isNotNull()).groupBy(named(df, column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their count. NULL passes."""
    strange = df.where(~named(df, column).isin(values))
    return strange.groupBy(named(df, column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Listed values that do occur."""
    return df.where(named(df, column).isin(values)).select(named(df, column).alias("value_field")).distinct()


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once; NULLs are equal to each other."""
    counted = df.groupBy(*_keys(df, columns)).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where("__n > 1").drop("__n")


def at_least_one(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups without a single non-NULL value; the whole table is one group by default."""
    names = as_list(group_by)
    # One value decides an ungrouped check, so every task may stop at its first.
    rows = df if names else df.where(named(df, column).isNotNull()).select(named(df, column)).limit(1)
    counts = rows.groupBy(*_keys(rows, names)).agg(F.count(named(df, column)).alias("filler_column"))
    return counts.where("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by=()) -> DataFrame:
    """Groups with exactly one distinct value, NULLs aside.

    One distinct value means that minimum and maximum agree, which needs no distinct count.
    """
    value = named(df, column)
    bounds = df.groupBy(*_keys(df, group_by)).agg(F.min(value).alias("__min"), F.max(value).alias("__max"))
    single = bounds.where(F.col("__min") == F.col("__max")).drop("__min", "__max")
    return single.withColumn("filler_column", F.lit(1).cast("long"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1, group_by=()) -> DataFrame:
    """Groups whose share of non-NULL values lies outside the bounds; an empty table has no share and passes."""
    share = F.try_divide(F.count(named(df, column)), F.count(F.lit(1))).alias("not_null_proportion")
    shares = df.groupBy(*_keys(df, group_by)).agg(share)
    return shares.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(df: DataFrame, field, unit: str, interval: int, ignore_time: bool = False, group_by=(),
            now: datetime | Column | None = None) -> DataFrame:
    """Groups whose latest ``field`` is older than ``interval`` units before ``now`` (the current time)."""
    present = F.current_timestamp() if now is None else moment(now)
    stamp_type = "date" if ignore_time else df.select(named(df, field).alias("f")).schema["f"].dataType
    threshold = add_units(unit, F.lit(-interval), present).cast(stamp_type)
    latest = df.groupBy(*_keys(df, group_by)).agg(F.max(named(df, field)).cast(stamp_type).alias("most_recent"))
    return latest.withColumn("threshold", threshold).where(F.col("most_recent") < F.col("threshold"))


# --- checks of two tables -------------------------------------------------------------------


def _keys(df: DataFrame, names) -> list[Column]:
    return [named(df, n) for n in as_list(names)]


def _counts_side_by_side(df: DataFrame, other: DataFrame, group_by, left: str, right: str) -> DataFrame:
    """Row counts per group of both tables. A group with a NULL key meets no counterpart."""
    names = as_list(group_by)
    a = df.groupBy(*[named(df, n).alias(f"{n}_a") for n in names]).agg(F.count(F.lit(1)).alias(left))
    b = other.groupBy(*[named(other, n).alias(f"{n}_b") for n in names]).agg(F.count(F.lit(1)).alias(right))
    if not names:  # one row each, put into one row
        unknown = F.lit(None).cast("long")
        both = a.withColumn(right, unknown).unionByName(b.withColumn(left, unknown))
        return both.agg(F.max(left).alias(left), F.max(right).alias(right))
    same = [quoted(f"{n}_a") == quoted(f"{n}_b") for n in names]
    columns = [quoted(f"{n}_{side}") for n in names for side in "ab"]
    return a.join(b, same, "full").select(*columns, left, right)


# How the failures of a check are counted, here and below.
EQUAL_ROWCOUNT_FAILURES = "sum(coalesce(diff_count, 0))"


def equal_rowcount(df: DataFrame, other: DataFrame, group_by=(), strict: bool = False) -> DataFrame:
    """Row counts of both tables per group and their difference, for every group.

    The check fails when the differences add up to more than 0. A group that one side lacks has no
    difference and passes, unless ``strict`` counts it as 0 rows.
    """
    counts = _counts_side_by_side(df, other, group_by, "count_a", "count_b")
    a, b = (_or_zero(c, strict) for c in ("count_a", "count_b"))
    return counts.withColumn("diff_count", F.abs(a - b))


FEWER_ROWS_FAILURES = "sum(coalesce(row_count_delta, 0))"


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by=(), strict: bool = False) -> DataFrame:
    """Row counts of both tables per group, and by how much ``df`` has too many.

    An equal count is 1 too many. A group that one side lacks passes, unless ``strict``.
    """
    counts = _counts_side_by_side(df, other, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = (_or_zero(c, strict) for c in ("count_our_model", "count_comparison_model"))
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("long"))


def _or_zero(name: str, strict: bool) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) if strict else F.col(name)


EQUALITY_FAILURES = "count(*) + abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a'))"


def equality(df: DataFrame, other: DataFrame, columns: list[str] | None = None, strict: bool = False,
             by_bucket: bool = False) -> DataFrame:
    """Rows only one of the tables has. Duplicates are ignored unless ``strict``.

    ``by_bucket`` is for tables that should be equal: checksums of buckets are compared first, and only rows of
    buckets that differ are shuffled.
    """
    return (differences_by_bucket if by_bucket else differences)(df, other, columns, multiset=strict)


def cardinality_equality(df: DataFrame, column: str, other: DataFrame, field: str) -> DataFrame:
    """Values, with their counts, that occur in different numbers in the two columns.

    A value both sides have is returned twice, once with each count.
    """
    a = df.select(named(df, column).alias(column), F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = other.select(named(other, field).alias(column), F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    counted = a.unionAll(b).groupBy(quoted(column)).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    counts = F.filter(F.array("__a", "__b"), lambda n: n > 0)
    return counted.where("__a <> __b").select(quoted(column), F.explode(counts).alias("num_rows"))


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "true",
                        to_condition: str = "true") -> DataFrame:
    """Non-NULL values of ``column`` that ``field`` lacks, one row for each occurrence.

    Occurrences are counted before the join, so a hot value crosses the network as one row.
    """
    ids = df.where(from_condition).select(named(df, column).alias("id")).where("id is not null")
    known = to.where(to_condition).select(named(to, field).alias("id")).where("id is not null").distinct()
    missing = ids.groupBy("id").agg(F.count(F.lit(1)).alias("__n")).join(known, "id", "left_anti")
    id_type = ids.schema["id"].dataType
    return repeat_rows(missing, "__n").withColumn("right_id", F.lit(None).cast(id_type))


def columns_match_set(df: DataFrame, expected: Iterable[str], transform: str = "upper") -> DataFrame:
    """Names that only the table or only the expected list has. Works on the schema alone."""
    change = {"upper": str.upper, "lower": str.lower}[transform]
    own, wanted = ({change(n) for n in names} for names in (df.columns, expected))
    rows = [(n, None) for n in sorted(own - wanted)] + [(None, n) for n in sorted(wanted - own)]
    return df.sparkSession.createDataFrame(rows, "relation_column string, input_column string")


# --- checks of neighbouring rows ------------------------------------------------------------

# How the end of a range may relate to the start of the next one, and the name of that test.
GAP_RULES = {
    "not_allowed": (lambda end, start: end == start, "equal_to"),
    "allowed": (lambda end, start: end <= start, "less_than_or_equal_to"),
    "required": (lambda end, start: end < start, "less_than"),
}


def mutually_exclusive_ranges(df: DataFrame, lower, upper, partition_by=None, gaps: str = "allowed",
                              zero_length_range_allowed: bool = False) -> DataFrame:
    """Ranges that are reversed, or that break the gap rule with the next range of their partition.

    Only neighbours in the order of (lower, upper) are compared. A NULL bound is a violation, a
    missing successor is not.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}, got {gaps!r}")
    if not isinstance(zero_length_range_allowed, bool):
        raise ValueError("zero_length_range_allowed must be true or false")
    follows, words = GAP_RULES[gaps]
    group = [] if partition_by is None else ["partition_by_col"]
    bounds = df.select(
        *[named(df, partition_by).alias(name) for name in group],
        named(df, lower).alias("lower_bound"), named(df, upper).alias("upper_bound"))
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ordered = low <= high if zero_length_range_allowed else low < high
    order_name = f"lower_bound_less_than{'_or_equal_to' if zero_length_range_allowed else ''}_upper_bound"
    gap_name = f"upper_bound_{words}_next_lower_bound"
    checked = (
        with_next(bounds, group, ["lower_bound", "upper_bound"])
        .withColumn("next_lower_bound", F.col(NEXT).getField("lower_bound"))
        .withColumn("is_last_record", F.col(NEXT).isNull())
        .withColumn(order_name, F.coalesce(ordered, F.lit(False)))
        .withColumn(gap_name, F.coalesce(follows(high, following), F.col("is_last_record")))
        .where(~(F.col(order_name) & F.col(gap_name)))
    )
    return repeat_rows(checked.drop(NEXT), COPIES)


def sequential_values(df: DataFrame, column: str, interval: int = 1, unit: str | None = None, group_by=()) -> DataFrame:
    """Values that are not their predecessor plus ``interval`` (units of time, if ``unit`` is given).

    Every value is looked at from its predecessor, so the first value of a group is never reported.
    """
    names = as_list(group_by)
    previous = f"previous_{slug(column)}"
    # NULLs neither violate the rule nor break it for a neighbour
    rows = df.select(*_keys(df, names), named(df, column)).where(quoted(column).isNotNull())
    pairs = with_next(rows, names, [column]).where(F.col(NEXT).isNotNull())
    value, before = F.col(NEXT).getField(column), quoted(column)
    if unit is None:
        expected, found = before + F.lit(interval), value
    else:
        without_zone = rows.schema[column].dataType.typeName() in ("date", "timestamp_ntz")
        stamp = "timestamp_ntz" if without_zone else "timestamp"
        expected, found = add_units(unit, F.lit(interval), before).cast(stamp), value.cast(stamp)
    broken = pairs.where(found != expected)
    shown = [*[quoted(n) for n in names], value.alias(column), before.alias(previous), COPIES]
    return repeat_rows(broken.select(shown), COPIES)
