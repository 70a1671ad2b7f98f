"""Number series and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType

from millrace.functions.dates import CALENDAR_UNITS, add_units, checked_unit, count_units
from millrace.literals import constants, moment


def number_series(spark: SparkSession, upper: int) -> DataFrame:
    """1 to ``upper`` in ``generated_number``."""
    if upper < 1:
        raise ValueError(f"upper bound must be at least 1, got {upper}")
    return spark.range(1, upper + 1).toDF("generated_number")


def intervals_between(spark: SparkSession, start, end, unit: str) -> int:
    """Unit boundaries from ``start`` to ``end``; 1 where the difference is unknown.

    Brings one number to the driver: it sizes the series that follows.
    """
    found = spark.range(1).select(count_units(unit, moment(start), moment(end))).first()[0]
    return 1 if found is None else int(found)


def date_spine(spark: SparkSession, unit: str, start, end) -> DataFrame:
    """One row per unit from ``start`` up to, but without, ``end``, in ``date_<unit>``.

    ``start`` and ``end`` are dates, times, SQL expressions or scalar subqueries.
    """
    unit = checked_unit(unit)
    start, end = moment(start), moment(end)
    count = intervals_between(spark, start, end, unit)
    if count < 1:
        raise ValueError(f"no {unit} lies between start and end")
    bounds = spark.range(1).select(start.alias("start"), end.alias("end"))
    whole_days = isinstance(bounds.schema["start"].dataType, DateType) and unit in CALENDAR_UNITS
    first, last = (value.cast("timestamp_ntz") for value in constants(bounds).values())
    name = f"date_{unit}"
    times = spark.range(count).select(add_units(unit, F.col("id"), first).alias(name))
    return times.where(F.col(name) <= last).select(F.col(name).cast("date" if whole_days else "timestamp_ntz"))
