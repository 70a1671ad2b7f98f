"""Turning user arguments into columns."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

ORDER_ITEM = re.compile(r"^(?P<key>.+?)(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?$", re.I | re.S)


def as_column(value) -> Column:
    """SQL text becomes an expression, a Column stays as it is, anything else is a literal."""
    if isinstance(value, Column):
        return value
    return F.expr(value) if isinstance(value, str) else F.lit(value)


def as_list(value) -> list:
    """None is the empty list, a single item a list of one."""
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def quoted(name: str) -> Column:
    """The column called exactly ``name``, also where the name holds dots, blanks or backticks."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")


class SortKey(NamedTuple):
    """One key of a sort order."""

    column: Column
    descending: bool
    nulls_first: bool

    def sorted(self, column: Column | None = None) -> Column:
        """The key, or another column in its place, with direction and NULL order."""
        way, nulls = "desc" if self.descending else "asc", "first" if self.nulls_first else "last"
        return getattr(self.column if column is None else column, f"{way}_nulls_{nulls}")()

    def comparable(self) -> list[Column]:
        """Columns that compare like the key: smallest first if ascending, greatest first if descending."""
        null_is_greatest = self.descending == self.nulls_first
        return [self.column.isNull() if null_is_greatest else self.column.isNotNull(), self.column]


def sort_keys(items) -> list[SortKey]:
    """Keys of texts such as ``"ts desc"``.

    Where the text does not say, NULL counts as the largest value: last when ascending, first when
    descending. That is the warehouse's rule and the opposite of Spark's.
    """
    keys = []
    for item in as_list(items):
        parts = ORDER_ITEM.match(item.strip())
        descending = (parts["way"] or "asc").lower() == "desc"
        nulls_first = descending if parts["nulls"] is None else parts["nulls"].lower() == "first"
        keys.append(SortKey(F.expr(parts["key"]), descending, nulls_first))
    return keys


def named(df: DataFrame, text: str | Column) -> Column:
    """The column of ``df`` called ``text``, or else the SQL expression, under that name."""
    if isinstance(text, Column):
        return text
    return quoted(text) if text in df.columns else F.expr(text).alias(text)


def ordering(items) -> list[Column]:
    """Sort columns from texts, as in ``sort_keys``, and from columns, which stay as they are."""
    return [item if isinstance(item, Column) else sort_keys(item)[0].sorted() for item in as_list(items)]
