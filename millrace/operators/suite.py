"""Running many checks and reporting one row for each.

Checks of single rows and checks of whole-table measures are aggregates, so all of them on one table come out of
one scan. Tables are told apart by their plans, not by the Python objects that stand for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import as_column, named
from millrace.functions.dates import add_units
from millrace.literals import moment


@dataclass(frozen=True)
class Rating:
    """When a number of failures is an error or a warning, as conditions such as ``"!= 0"`` or ``"> 10"``."""

    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"

    def status(self, failures: str) -> Column:
        """Status for the failure count in the column called ``failures``."""
        if self.severity not in ("error", "warn"):
            raise ValueError(f"severity must be error or warn, got {self.severity!r}")
        warn = F.when(F.expr(f"{failures} {self.warn_if}"), "warn").otherwise("pass")
        if self.severity == "warn":
            return warn
        return F.when(F.expr(f"{failures} {self.error_if}"), "error").otherwise(warn)


@dataclass(frozen=True)
class RowCheck:
    """A check of single rows: ``violation`` is true for a bad row of ``table``.

    ``where`` limits the check to some rows. All row checks of one table share one scan.
    """

    name: str
    table: DataFrame
    violation: Column | str
    where: Column | str | None = None
    rating: Rating = Rating()


@dataclass(frozen=True)
class MeasureCheck:
    """A check of aggregates over whole tables.

    ``measures`` gives each measure a table and an aggregate that is a whole number; ``failures`` makes the number
    of failures from their columns. Measures of one table share a scan with each other and with the row checks of
    that table.
    """

    name: str
    measures: Mapping[str, tuple[DataFrame, Column | str]]
    failures: Callable[[Mapping[str, Column]], Column]
    rating: Rating = Rating()


@dataclass(frozen=True)
class TableCheck:
    """Any other check: a frame of violations and how failures are counted from it."""

    name: str
    violations: DataFrame
    fail_calc: str = "count(*)"
    rating: Rating = Rating()


def _measures_of(check: RowCheck | MeasureCheck) -> Mapping[str, tuple[DataFrame, Column]]:
    if isinstance(check, MeasureCheck):
        return {name: (table, as_column(aggregate)) for name, (table, aggregate) in check.measures.items()}
    broken = as_column(check.violation)
    bad = broken if check.where is None else as_column(check.where) & broken
    return {"failures": (check.table, F.count_if(bad))}


def _scanned(checks: list[RowCheck | MeasureCheck]) -> DataFrame:
    """The lines of these checks: one scan per table, and a grouping of the measures, which are a few rows."""
    tables: list[tuple[DataFrame, list]] = []
    for number, check in enumerate(checks):
        for name, (table, aggregate) in _measures_of(check).items():
            wanted = next((w for known, w in tables if known is table or known.sameSemantics(table)), None)
            if wanted is None:
                tables.append((table, wanted := []))
            wanted.append((number, name, aggregate))

    def measured(table: DataFrame, wanted: list) -> DataFrame:
        values = table.agg(*[aggregate.cast("long").alias(f"a{i}") for i, (_, _, aggregate) in enumerate(wanted)])
        rows = [F.struct(F.lit(number).alias("check"), F.lit(name).alias("name"), F.col(f"a{i}").alias("value"))
                for i, (number, name, _) in enumerate(wanted)]
        return values.select(F.inline(F.array(*rows)))

    every = reduce(DataFrame.unionAll, [measured(*each) for each in tables])
    entries = F.collect_list(F.struct("name", F.struct("value").alias("value")))
    grouped = every.groupBy("check").agg(F.map_from_entries(entries).alias("m"))
    failures, lines = F.lit(None).cast("long"), F.lit(None)
    for number, check in enumerate(checks):
        values = {name: F.col("m")[name]["value"] for name in _measures_of(check)}
        count = values["failures"] if isinstance(check, RowCheck) else check.failures(values)
        failures = F.when(F.col("check") == number, count.cast("long")).otherwise(failures)
        lines = F.when(F.col("check") == number, F.struct(*_line(check, "failures"))).otherwise(lines)
    counted = grouped.select("check", F.coalesce(failures, F.lit(0).cast("long")).alias("failures"))
    return counted.select(lines.alias("line")).select("line.*")


def _table_check(check: TableCheck) -> DataFrame:
    failures = F.coalesce(F.expr(check.fail_calc).cast("long"), F.lit(0).cast("long"))
    return check.violations.agg(failures.alias("failures")).select(_line(check, "failures"))


def _line(check: RowCheck | MeasureCheck | TableCheck, failures: str) -> list[Column]:
    return [
        F.lit(check.name).alias("check_name"),
        F.col(failures).alias("failures"),
        check.rating.status(failures).alias("status"),
    ]


def run_checks(checks: list[RowCheck | MeasureCheck | TableCheck]) -> DataFrame:
    """One row per check: ``check_name``, ``failures``, ``status`` (pass, warn or error)."""
    if not checks:
        raise ValueError("no checks given")
    names = [c.name for c in checks]
    if len(set(names)) < len(names):
        raise ValueError("check names must differ")
    scanned = [c for c in checks if not isinstance(c, TableCheck)]
    parts = [_scanned(scanned)] if scanned else []
    return reduce(DataFrame.unionAll, [*parts, *[_table_check(c) for c in checks if isinstance(c, TableCheck)]])


# --- whole-table checks as measures ---------------------------------------------------------


def equal_rowcount_check(name: str, df: DataFrame, other: DataFrame, rating: Rating = Rating()) -> MeasureCheck:
    """``quality.equal_rowcount`` without groups: the difference of the row counts."""
    rows = F.count(F.lit(1))
    return MeasureCheck(name, {"a": (df, rows), "b": (other, rows)}, lambda m: F.abs(m["a"] - m["b"]), rating)


def fewer_rows_check(name: str, df: DataFrame, other: DataFrame, rating: Rating = Rating()) -> MeasureCheck:
    """``quality.fewer_rows_than`` without groups: by how many rows the table has too many, 1 for an equal count."""
    rows = F.count(F.lit(1))

    def surplus(m: Mapping[str, Column]) -> Column:
        return F.when(m["a"] > m["b"], m["a"] - m["b"]).when(m["a"] == m["b"], 1).otherwise(0)

    return MeasureCheck(name, {"a": (df, rows), "b": (other, rows)}, surplus, rating)


def at_least_one_check(name: str, df: DataFrame, column, rating: Rating = Rating()) -> MeasureCheck:
    """``quality.at_least_one`` without groups: 1 if there is no value."""
    return MeasureCheck(name, {"n": (df, F.count(named(df, column)))}, lambda m: (m["n"] == 0).cast("int"), rating)


def not_constant_check(name: str, df: DataFrame, column, rating: Rating = Rating()) -> MeasureCheck:
    """``quality.not_constant`` without groups: 1 if there is exactly one distinct value."""
    value = named(df, column)
    return MeasureCheck(name, {"one": (df, (F.min(value) == F.max(value)).cast("int"))}, lambda m: m["one"], rating)


def not_null_proportion_check(name: str, df: DataFrame, column, at_least: float, at_most: float = 1,
                              rating: Rating = Rating()) -> MeasureCheck:
    """``quality.not_null_proportion`` without groups: 1 if the share lies outside the bounds."""
    measures = {"n": (df, F.count(named(df, column))), "whole": (df, F.count(F.lit(1)))}

    def outside(m: Mapping[str, Column]) -> Column:
        share = F.try_divide(m["n"], m["whole"])
        return ((share < at_least) | (share > at_most)).cast("int")

    return MeasureCheck(name, measures, outside, rating)


def recency_check(name: str, df: DataFrame, field, unit: str, interval: int, now: datetime | Column | None = None,
                  rating: Rating = Rating()) -> MeasureCheck:
    """``quality.recency`` without groups: 1 if the latest time is older than so many units before ``now``."""
    present = F.current_timestamp() if now is None else moment(now)
    kind = df.select(named(df, field).alias("f")).schema["f"].dataType
    old = F.max(named(df, field)) < add_units(unit, F.lit(-interval), present).cast(kind)
    return MeasureCheck(name, {"old": (df, old.cast("int"))}, lambda m: m["old"], rating)

