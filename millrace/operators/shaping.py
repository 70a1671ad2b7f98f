"""Choosing, renaming and cleaning columns; pivot and unpivot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from millrace.functions.columns import as_column, as_list, named, quoted
from millrace.functions.text import empty_to_null, slug


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Column names without the excluded ones, in any letter case."""
    dropped = {name.lower() for name in exclude}
    return [name for name in df.columns if name.lower() not in dropped]


def star(df: DataFrame, exclude: Iterable[str] = (), prefix: str = "", suffix: str = "",
         relation_alias: str | None = None) -> list[Column]:
    """Columns of ``df`` for ``select`` or ``groupBy``, renamed only where a prefix or suffix is given."""
    columns = []
    for name in filtered_columns(df, exclude):
        escaped = name.replace("`", "``")
        column = F.col(f"{relation_alias}.`{escaped}`") if relation_alias else quoted(name)
        columns.append(column.alias(f"{prefix}{name}{suffix}") if prefix or suffix else column)
    return columns


def leading_columns(df: DataFrame, n: int) -> list[Column]:
    """The first ``n`` columns, as grouping keys."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"n must lie between 1 and {len(df.columns)}, got {n}")
    return [quoted(name) for name in df.columns[:n]]


def nullcheck(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty strings become NULL in the given columns, or in all; other types are left alone."""
    chosen = set(df.columns if columns is None else columns)
    return df.select([
        empty_to_null(quoted(f.name)).alias(f.name)
        if f.name in chosen and isinstance(f.dataType, StringType) else quoted(f.name)
        for f in df.schema.fields
    ])


# Comparisons a pivot may use between the pivot column and each value.
COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
    "not like": lambda c, v: ~c.like(v),
    "not ilike": lambda c, v: ~c.ilike(v),
    "is not distinct from": lambda c, v: c.eqNullSafe(v),
    "is distinct from": lambda c, v: ~c.eqNullSafe(v),
}
PATTERNS = ("like", "ilike", "not like", "not ilike")

DISTINCT_AGGREGATES = {
    "sum": F.sum_distinct,
    "count": F.count_distinct,
    "avg": lambda c: F.sum_distinct(c) / F.count_distinct(c),
    "min": F.min,
    "max": F.max,
}


def _conditional(column, value, comparison: str, then_value, else_value) -> Column:
    try:
        compare = COMPARISONS[comparison.lower()]
    except KeyError:
        raise ValueError(f"unknown comparison {comparison!r}, expected one of {sorted(COMPARISONS)}") from None
    matches = compare(as_column(column), value if comparison.lower() in PATTERNS else F.lit(value))
    return F.when(matches, as_column(then_value)).otherwise(as_column(else_value))


def pivot_columns(column, values, agg: str = "sum", comparison: str = "=", prefix: str = "", suffix: str = "",
                  then_value=1, else_value=0, slugs: bool = False, distinct: bool = False,
                  alias: bool = True) -> list[Column]:
    """One aggregate per value, all computed in the same grouping.

    A NULL in the pivot column matches no value. With ``agg="count"`` every row counts unless
    ``else_value`` is None.
    """
    aggregate = DISTINCT_AGGREGATES[agg] if distinct else getattr(F, agg)
    columns = []
    for value in values:
        total = aggregate(_conditional(column, value, comparison, then_value, else_value))
        name = f"{prefix}{value}{suffix}"
        columns.append(total.alias(slug(name) if slugs else name) if alias else total)
    return columns


def pivot(df: DataFrame, group_by, column, values, agg: str = "sum", comparison: str = "=", then_value=1,
          else_value=0, distinct: bool = False, **naming) -> DataFrame:
    """Group ``df`` and turn the values of ``column`` into columns.

    Distinct aggregates over several values make Spark copy each row once per value. Where a row can
    match one value only, duplicates are removed first by an ordinary aggregation; then every value is
    distinct already, and ``else_value`` counts once where a row of the group does not match.
    """
    keys = [named(df, key) for key in as_list(group_by)]
    column, then_value = (named(df, c) if isinstance(c, str) else c for c in (column, then_value))
    if distinct and comparison == "=":
        names = [f"__key{i}" for i in range(len(keys))]
        # The branch that is never taken gives the value the type it has beside ``else_value``.
        value = F.when(F.lit(True), as_column(then_value)).otherwise(as_column(else_value))
        unique = df.select(*[key.alias(name) for key, name in zip(keys, names, strict=True)],
                           as_column(column).alias("__column"), value.alias("__value")).distinct()
        totals = [_distinct_total(agg, v, else_value) for v in values]
        labels = df.select(*keys).columns
        titles = df.select(*pivot_columns(F.lit(None), values, agg, distinct=False, **naming)).columns
        wide = unique.groupBy(*names).agg(*[t.alias(f"__total{i}") for i, t in enumerate(totals)])
        return wide.select(*[F.col(n).alias(l) for n, l in zip(names, labels, strict=True)],
                           *[F.col(f"__total{i}").alias(title) for i, title in enumerate(titles)])
    totals = pivot_columns(column, values, agg, comparison, then_value=then_value, else_value=else_value,
                           distinct=distinct, **naming)
    return df.groupBy(*keys).agg(*totals)


def _distinct_total(agg: str, value, else_value) -> Column:
    """Distinct aggregate over rows of ``__column`` and ``__value`` that hold no row twice."""
    if agg not in DISTINCT_AGGREGATES:
        raise ValueError(f"unknown distinct aggregate {agg!r}, expected one of {sorted(DISTINCT_AGGREGATES)}")
    matches = F.col("__column") == F.lit(value)
    if else_value is None:
        one, other = F.when(matches, F.col("__value")), None
    else:
        # A matching value equal to ``else_value`` is counted with it, once.
        other = as_column(else_value)
        same = matches & (F.col("__value") == other)
        one = F.when(matches & ~same, F.col("__value"))
        seen = F.coalesce(F.max(F.coalesce(same, F.lit(False)) | ~F.coalesce(matches, F.lit(False))), F.lit(False))
    if agg in ("min", "max"):
        best = getattr(F, agg)(one)
        pick = F.least if agg == "min" else F.greatest
        return best if other is None else pick(best, F.when(seen, other))
    count = F.count(one) + (F.lit(0) if other is None else seen.cast("int"))
    if agg == "count":
        return count
    total = F.sum(one)
    if other is not None:
        total = F.when(seen, F.coalesce(total, F.lit(0)) + other).otherwise(total)
    return total if agg == "sum" else total / count


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Iterable[str] = (), remove: Iterable[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """One row per input row and value column, in a single pass; NULL values are kept.

    ``exclude`` columns are repeated on every row, ``remove`` columns are left out.
    """
    kept = list(exclude)
    values = filtered_columns(df, [*kept, *remove])
    if not values:
        raise ValueError("no columns are left to unpivot")
    cast = df.select(*[quoted(c) for c in kept], *[quoted(c).cast(cast_to).alias(c) for c in values])
    return cast.unpivot([quoted(c) for c in kept], [quoted(c) for c in values], field_name, value_name)
