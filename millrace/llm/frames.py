"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a Python function sees at a time, which bounds what it has to hold beside a batch.
SLICE_ROWS = 2048

BatchFunction = Callable[[pa.RecordBatch], list[pa.Array]]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(df: DataFrame, name: str):
    """A column of the frame by its plain name, dots and blanks included."""
    return df[quoted(name)]


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many ``_`` before it as it takes for no column to have it, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def append(df: DataFrame, fields: str, make: Callable[[], BatchFunction], drop: tuple[str, ...] = (),
           rows: int = SLICE_ROWS) -> DataFrame:
    """The frame with the columns of the DDL string ``fields``, which a Python function makes per Arrow batch.

    ``make`` runs once in every task and returns that function, so that a model is loaded once per
    task. A column of the frame that has the name of a new one, in any letter case, is replaced;
    the function still sees it. ``drop`` names input columns that the result leaves out. The function
    sees at most ``rows`` rows at a time.
    """
    added = T.StructType.fromDDL(fields)
    gone = {n.lower() for n in (*added.names, *drop)}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = T.StructType([*kept, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
            new = work(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def tidy(run):
    """The batch function, giving freed memory back to the system when its task ends.

    Python workers live on from task to task and from stage to stage; without this each keeps what its
    largest slice ever took.
    """

    def kept_small(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return kept_small


def give_back() -> None:
    """Gives freed memory back to the system, which otherwise stays with the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def held_out_remainder(df: DataFrame, id_column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; of null the remainder is that of the empty text."""
    return F.crc32(F.coalesce(column(df, id_column).cast("string"), F.lit("")).cast("binary")) % parts


#: Values that one row of a partial sum holds.
CHUNK = 1 << 15


def summed(df: DataFrame, accumulate: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """Sum over the partitions of the vector of doubles that ``accumulate`` makes of each.

    Partitions hand on their vector in chunks, and each chunk is added up in a task of its own, so
    that neither a task nor the driver holds more than one vector per partition chunk, or one
    vector. The order of addition is that of the partitions, whatever order tasks end in.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        vector = np.ascontiguousarray(accumulate(batches), np.float64)
        parts = [vector[a:a + CHUNK].tobytes() for a in range(0, length, CHUNK)]
        if vector.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([number] * len(parts), pa.int32()), pa.array(parts, pa.binary())],
                names=["chunk", "number", "part"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        total = np.frombuffer(rows["part"].iloc[0], np.float64).copy()
        for part in rows["part"].iloc[1:]:
            total += np.frombuffer(part, np.float64)
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "total": [total.tobytes()]})

    parts = df.mapInArrow(tidy(partial), "chunk int, number int, part binary")
    out = np.zeros(length)
    for row in parts.groupBy("chunk").applyInPandas(add, "chunk int, total binary").collect():
        total = np.frombuffer(row.total, np.float64)
        out[row.chunk * CHUNK:row.chunk * CHUNK + len(total)] = total
    return out


def about(df: DataFrame, id_column: str, rows: int) -> DataFrame:
    """All rows if there are at most ``rows``, else about that many, chosen by a hash of their id."""
    count = df.count()
    if count <= rows:
        return df
    share = int(rows / count * (1 << 30))
    return df.where(F.pmod(F.xxhash64(column(df, id_column)), F.lit(1 << 30)) < share)
