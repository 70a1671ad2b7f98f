"""Values that enter a plan as literals."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampType

from millrace.functions.columns import as_column, quoted


def moment(value) -> Column:
    """A date or time as a literal, text as an SQL expression. A time without zone stays without one."""
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value) if isinstance(value, date) else as_column(value)


def constants(one_row: DataFrame) -> dict[str, Column]:
    """The values of a one-row frame as literals of the same type.

    Literals let a scan skip row groups, also where several are combined by OR; subqueries combined
    that way would not. They also fix the marks before anything is appended.
    """
    return {name: F.expr(text) for name, text in literal_texts(one_row.limit(1))[0].items()}


def literal_texts(few_rows: DataFrame) -> list[dict[str, str]]:
    """The values of a frame of a few rows as SQL literals of the same types."""
    fields = few_rows.schema.fields
    moments = {f.name for f in fields if isinstance(f.dataType, TimestampType)}

    def text(name: str) -> Column:
        return F.unix_micros(quoted(name)) if name in moments else quoted(name).cast("string")

    def literal(field, value) -> str:
        if value is None:
            return f"cast(null as {field.dataType.simpleString()})"
        if field.name in moments:
            return f"timestamp_micros({value}L)"
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"cast('{escaped}' as {field.dataType.simpleString()})"

    rows = few_rows.select([text(f.name).alias(f.name) for f in fields]).collect()
    return [{f.name: literal(f, row[f.name]) for f in fields} for row in rows]
