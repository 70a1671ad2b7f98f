"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_column

# A key must hash to the same text as the keys already stored in a warehouse.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*fields, nulls_as_empty: bool = False) -> Column:
    """md5 of the fields' text joined by a dash, with a mark in place of NULL.

    ``nulls_as_empty`` gives the older keys, in which NULL and the empty string are the same.
    Key on strings, integers and decimals: the text of a double differs between engines.
    """
    if not fields:
        raise ValueError("a surrogate key needs at least one field")
    mark = F.lit("" if nulls_as_empty else NULL_MARK)
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(as_column(f).cast("string"), mark) for f in fields]))
