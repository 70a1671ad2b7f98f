"""Hashes of whole rows, for comparing tables without sending their rows anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from millrace.functions.columns import quoted


def hashable(value: Column, kind: DataType) -> Column:
    """A value of a type that can be hashed, with NULLs inside it told apart; a map becomes its sorted entries."""
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            F.to_json(F.struct(e["key"])).alias("key"), F.to_json(F.struct(e["value"]), {"ignoreNullFields": "false"}).alias("value")))
        return F.sort_array(entries)
    if isinstance(kind, (ArrayType, StructType)):
        return F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    return value


def row_hash(df: DataFrame, names: list[str], seed: int | None = None) -> Column:
    """64 bits of the named columns of a row; NULL differs from every value, and other seeds give independent hashes."""
    parts = [c for name in names for c in (quoted(name).isNull(), hashable(quoted(name), df.schema[name].dataType))]
    return F.xxhash64(*([] if seed is None else [F.lit(seed)]), *parts)


def same_to_grouping_and_hash(df: DataFrame, names: list[str]) -> bool:
    """Whether values that grouping takes for equal have one hash: not so for collated texts, and for fractions inside other values."""
    kinds = [df.schema[n].dataType.simpleString() for n in names]
    return not any("collate" in k or (k not in ("float", "double") and ("float" in k or "double" in k)) for k in kinds)
