"""Mergeable values per key, kept as one small table per load.

High-water marks and running summaries change with every load, and a load touches few keys. So a load writes
only the values of its own rows, in a folder that carries its number, and reading merges what the folders hold.
Now and then a fold writes the merged values of all loads so far into one folder, and readers take that in
place of the others.

A load that is repeated after a failure writes the same folder again, and nothing that reads the state before a
load looks at folders of that load or later ones. So a load may be repeated any number of times.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.columns import quoted
from millrace.sources.tables import DEFAULT_FORMAT, read_table_if_exists, refresh

#: Folder names: the first and last load that an entry covers.
FIRST, LAST = "__first", "__last"


@dataclass(frozen=True)
class Kept:
    """Values below ``path`` by ``keys``; ``merges`` names for each value the aggregate that merges it, such as ``F.max``."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    merges: Mapping[str, object]
    fmt: str = DEFAULT_FORMAT

    def _merged(self, rows: DataFrame) -> DataFrame:
        values = [merge(quoted(name)).alias(name) for name, merge in self.merges.items()]
        return rows.groupBy(*[quoted(k) for k in self.keys]).agg(*values)

    def _written(self, rows: DataFrame, first: int, last: int) -> None:
        columns = [quoted(c) for c in (*self.keys, *self.merges)]
        rows.select(columns).write.format(self.fmt).mode("overwrite").save(f"{self.path}/{LAST}={last}/{FIRST}={first}")
        refresh(self.spark, self.path)

    def entries(self, before: int | None = None) -> list[tuple[int, int]]:
        """First and last load of the folders that together hold all loads below ``before`` once, latest first.

        Only names of folders are looked at; there is one for each load, and one for each fold.
        """
        names = read_table_if_exists(self.spark, self.path, self.fmt)
        if names is None:
            return []
        found = {(int(r[0]), int(r[1])) for r in names.select(FIRST, LAST).distinct().collect()}
        chosen: list[tuple[int, int]] = []
        end = before
        while rest := [e for e in found if end is None or e[1] < end]:
            latest = max(last for _, last in rest)
            chosen.append(min(e for e in rest if e[1] == latest))
            end = chosen[-1][0]
        return chosen

    def current(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame | None:
        """Merged values of all loads with a number below ``before``; None if there are none.

        ``only`` limits them to the keys of some rows, before anything is merged.
        """
        chosen = self.entries(before)
        if not chosen:
            return None
        paths = [f"{self.path}/{LAST}={last}/{FIRST}={first}" for first, last in chosen]
        rows = self.spark.read.format(self.fmt).load(paths)
        if only is not None:
            wanted = only.select([quoted(k).alias(f"__{k}") for k in self.keys]).distinct()
            same = [quoted(k).eqNullSafe(quoted(f"__{k}")) for k in self.keys]
            rows = rows.join(wanted, same, "left_semi")
        return self._merged(rows)

    def put(self, number: int, rows: DataFrame) -> None:
        """The values of one load: ``rows`` hold keys and values, any number per key. Replaces an earlier try of this load."""
        self._written(self._merged(rows), number, number)

    def fold(self, number: int, after: int) -> bool:
        """Folds all loads up to ``number`` into one folder, if that spares readers ``after`` folders or more."""
        chosen = self.entries(number + 1)
        if len(chosen) <= after:
            return False
        self._written(self.current(number + 1), chosen[-1][0], number)
        return True


def marks(spark: SparkSession, path: str, keys: list[str], fmt: str = DEFAULT_FORMAT) -> Kept:
    """Greatest stamp per key, as ``__mark``."""
    return Kept(spark, path, tuple(keys), {"__mark": F.max}, fmt)


def summaries(spark: SparkSession, path: str, keys: list[str], averages: list[str], stamp: str, fmt: str = DEFAULT_FORMAT) -> Kept:
    """What averages, row counts and latest stamps per key are made of."""
    sums = {f"__{part}_{name}": F.sum for name in averages for part in ("sum", "count")}
    return Kept(spark, path, tuple(keys), {**sums, "number_of_rows": F.sum, stamp: F.max}, fmt)


def summary_parts(rows: DataFrame, keys: list[str], averages: list[str], stamp: str) -> DataFrame:
    """Rows in the shape that ``summaries`` keeps, one per row; merging adds them up before the shuffle."""
    parts: list[Column] = []
    for name in averages:
        kind = rows.schema[name].dataType
        # Decimals stay exact, everything else is averaged as a double.
        value = quoted(name) if kind.typeName() == "decimal" else quoted(name).cast("double")
        parts += [value.alias(f"__sum_{name}"), quoted(name).isNotNull().cast("long").alias(f"__count_{name}")]
    return rows.select(*[quoted(k) for k in keys], *parts, quoted(stamp).isNotNull().cast("long").alias("number_of_rows"), quoted(stamp))


def summary_of(kept: DataFrame, keys: list[str], averages: list[str], stamp: str) -> DataFrame:
    """The summary that ``weather.summarise`` makes of all rows, from the kept parts."""
    means = [F.try_divide(quoted(f"__sum_{c}"), quoted(f"__count_{c}")).alias(c) for c in averages]
    return kept.select(*[quoted(k) for k in keys], *means, "number_of_rows", quoted(stamp))
