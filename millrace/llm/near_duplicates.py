"""Near-duplicate classes from DartMinHash signatures, banded joining and an exact check.

A document is the weighted set of its five-word shingles; a shingle weighs as often as it occurs (or
1, with ``weights="set"``). Darts are thrown at the region of each element, which is as wide as its
weight: unit-wide cells receive darts at random times, the same in every document, and a last cell
of fractional width keeps the darts that land inside. Each dart is hashed to one of the coordinates,
and a coordinate keeps its earliest dart. Two documents agree in a coordinate with the probability
of their weighted Jaccard similarity. The horizon of time is set so that a document throws
k (ln k + 3) darts however long it is; where a coordinate stays empty, the horizon is doubled.

Documents of the same words are first folded into one. Signatures are cut into bands; documents that
agree in a band share a bucket. Then

1. every member of a bucket is compared with the bucket's leader, its smallest id, on whole shingle
   sets, and the links that reach ``threshold`` are joined into components;
2. what that leaves apart is compared with another member of its bucket, drawn by a hash, again and
   again as long as that settles a fair part of it. Members of one component, and members too far from
   each other by the triangle inequality of the Jaccard distance seen from the leader, are settled;
3. what is still apart is compared exactly inside its bucket, in blocks of bounded size that are spread
   over tasks; each two blocks hand on a spanning forest of their links, never all pairs. No bucket is
   capped, so a link between two documents that share a bucket is never lost.

The classes are the connected components of all links.

With 30 bands of 5 coordinates a pair of similarity 0.8 misses every band with probability 7e-6.

Edge cases: a document of one to four words is one shingle; one without words (null, empty) is a
class of its own, and so is a null id, whose class is null. Rows that share an id are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.components import components
from millrace.llm.frames import append, column, tidy
from millrace.llm.words import ALPHANUMERIC, Texts, Words, mixed, occurrence, runs_of_rows, slices, windows, words
from millrace.session import release, stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
BLOCK = 256
#: Tasks that the members of one bucket are spread over where they meet a row of their bucket.
SALTS = 32
#: Rounds with drawn leaders go on while each settles at least this share of what is left apart.
WORTH_A_ROUND = 0.2
BLOCK_CELLS = 4096
FILTER_BITS = (1 << 16, 1 << 27)

_STEP, _AIM, _SIDE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _unit(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(11)) * 2.0 ** -53


def _throw(cells: np.ndarray, width: np.ndarray | None, row: np.ndarray, reach: np.ndarray, k: int, out: np.ndarray) -> None:
    """All darts at the cells up to the horizon of their row; ``out`` (rows by k) keeps the earliest per coordinate."""
    limit, time = reach[row], np.zeros(len(cells))
    step = 0
    while len(cells):
        dart = mixed(cells + np.uint64(step * int(_STEP) % (1 << 64)))
        time = time - np.log1p(-_unit(dart))
        on = time <= limit
        cells, row, limit, time, dart = cells[on], row[on], limit[on], time[on], dart[on]
        aim = mixed(dart ^ _AIM)
        place = row * k + ((aim >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        value = time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | aim & np.uint64(0xFFFFFFFF)
        if width is None:
            np.minimum.at(out.reshape(-1), place, value)
        else:
            width = width[on]
            hit = _unit(mixed(dart ^ _SIDE)) < width
            np.minimum.at(out.reshape(-1), place[hit], value[hit])
        step += 1


def signatures(elements: np.ndarray, weights: np.ndarray | None, row: np.ndarray, rows: int, k: int) -> np.ndarray:
    """Earliest dart of each coordinate (columns) for each row; all ones for a row without elements.

    ``elements`` are 64-bit hashes, distinct within a row; ``weights`` are positive numbers, 1 if not given.
    """
    width = None
    if weights is not None:
        cells = np.maximum(1, np.ceil(weights)).astype(np.int64)
        index = np.repeat(np.arange(len(elements)), cells)
        nth = np.arange(len(index)) - np.repeat(np.cumsum(cells) - cells, cells)
        elements = cell_of(elements[index], nth)
        row, width = row[index], np.minimum(1.0, weights[index] - nth)
    mass = np.bincount(row, width, rows)
    out = np.full((rows, k), _EMPTY)
    todo = mass > 0
    reach = np.zeros(rows)
    reach[todo] = k * (np.log(k) + 3) / mass[todo]
    while todo.any():
        pick = todo[row]
        _throw(elements[pick], None if width is None else width[pick], row[pick], reach, k, out)
        todo &= (out == _EMPTY).any(axis=1)
        reach[todo] *= 2
    return out


def cell_of(elements: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Hash of the nth unit-wide cell of an element."""
    return mixed(elements + nth.astype(np.uint64) * _SIDE)


def shingle_cells(texts: Texts, weights: str) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, and cell and row of each unit of shingle weight."""
    found = words(texts, ALPHANUMERIC)
    shingle, row = windows(found, SHINGLE, len(texts))
    nth = occurrence(row, shingle)
    if weights == "set":
        first = nth == 0
        return found, cell_of(shingle[first], nth[first]), row[first]
    return found, cell_of(shingle, nth), row


def _prints(texts: Texts, found: Words) -> list[pa.Array]:
    """A cryptographic digest of the word sequence of each row, in two halves; null without words."""
    norm = ALPHANUMERIC[texts.data]
    inside = norm != 0
    flat, edges = norm[inside], np.concatenate([[0], np.cumsum(inside)])[texts.bounds].tolist()
    sizes, begins = found.end - found.start, runs_of_rows(found.row, len(texts)).tolist()
    digests = bytearray()
    for a, b, c, d in zip(edges, edges[1:], begins, begins[1:], strict=False):
        digest = hashlib.blake2b(flat[a:b], digest_size=16)
        digest.update(sizes[c:d])  # which bytes make a word
        digests += digest.digest()
    halves = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
    none = found.per_row(len(texts)) == 0
    return [pa.array(halves[:, k], mask=none) for k in (0, 1)]


def sketched(df: DataFrame, identity: str, text: str, bands: int, rows: int, weights: str) -> DataFrame:
    """``id``, a digest of the word sequence (null without words) and the band keys of every row."""
    k = bands * rows
    base = df.select(column(df, identity).alias("id"), column(df, text).alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            first, second, keys = [], [], []
            for part in slices(batch.column("text")):
                found, cells, row = shingle_cells(part, weights)
                sketch = signatures(cells, None, row, len(part), k)
                for out, value in zip((first, second), _prints(part, found), strict=True):
                    out.append(value)
                key = np.zeros((len(part), bands), np.uint64)
                for j in range(rows):
                    key = mixed(key + sketch[:, j::rows])
                key = mixed(key + np.arange(bands, dtype=np.uint64))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(key.ravel().view(np.int64)), bands).cast(pa.list_(pa.int64()))
                keys.append(lists)
            return [pa.concat_arrays(x) if x else pa.array([], t) for x, t in
                    ((first, pa.int64()), (second, pa.int64()), (keys, pa.list_(pa.int64())))]

        return work

    return append(base, "print_a long, print_b long, bands array<long>", make, drop=("text",))


def _id_filter(ids: DataFrame, count: int) -> np.ndarray:
    """Bits of the hashes of the ids, 16 MB at most; more ids only let more others pass."""
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], 1 << (10 * count).bit_length()))
    chunk = FILTER_BITS[0]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, bool)
        for batch in batches:
            seen[_filter_place(batch.column("hash").to_numpy(), bits)] = True
        full = [i for i in range(bits // chunk) if seen[i * chunk:(i + 1) * chunk].any()]
        parts = [np.packbits(seen[i * chunk:(i + 1) * chunk]).tobytes() for i in full]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "part"])

    def either(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.bitwise_or.reduce([np.frombuffer(p, np.uint8) for p in rows["part"]])
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "part": [total.tobytes()]})

    marks = ids.select(F.xxhash64("id").alias("hash")).mapInArrow(tidy(mark), "chunk int, part binary")
    out = np.zeros(bits, bool)
    for row in marks.groupBy("chunk").applyInPandas(either, "chunk int, part binary").collect():
        out[row.chunk * chunk:(row.chunk + 1) * chunk] = np.unpackbits(np.frombuffer(row.part, np.uint8))
    return out


def _filter_place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(hashes.view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def cell_sets(df: DataFrame, identity: str, text: str, ids: DataFrame, weights: str) -> DataFrame:
    """``id`` and ``cells`` of the documents of ``ids``, and of a few others.

    Others are left out by a filter of bounded size before anything is shuffled or written.
    """
    ids = ids.distinct()
    bits = _id_filter(ids, ids.count())
    sent = df.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())
    size = len(bits)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(wanted[_filter_place(batch.column("hash").to_numpy(), size)]))
            for part in slices(batch.column("text")):
                _, cell, row = shingle_cells(part, weights)
                edges = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(cell.view(np.int64)))
                own = batch.column("id").slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([own, lists], names=["id", "cells"])

    base = df.select(column(df, identity).alias("id"), column(df, text).alias("text")).where("id is not null")
    kind = base.schema["id"].dataType.simpleString()
    return base.withColumn("hash", F.xxhash64("id")).mapInArrow(tidy(cells), f"id {kind}, cells array<bigint>")


def without(df: DataFrame, identity: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is none of ``ids`` (one column), rows of a null id among them.

    Only rows that a filter of bounded size takes for one of ``ids`` are joined; all others stay where they are, so
    that their texts are not shuffled.
    """
    known = ids.toDF("id").where("id is not null").distinct()
    count = known.count()
    if not count:
        return df
    bits = _id_filter(known, count)
    sent, size = df.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes()), len(bits)

    @F.pandas_udf("boolean")
    def listed(hashes: pd.Series) -> pd.Series:
        place = _filter_place(hashes.to_numpy(np.int64), size)
        return pd.Series(np.frombuffer(sent.value, np.uint8)[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1 == 1)

    own = column(df, identity)
    maybe = listed(F.xxhash64(own))
    tested = df.where(maybe)
    return df.where(~maybe).union(tested.join(known, column(tested, identity) == known["id"], "left_anti"))


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x``, ``y`` and the exact similarity of each pair of documents; ``x`` may stand in many pairs."""
    left = pairs.join(sets.withColumnRenamed("id", "x"), "x").withColumnRenamed("cells", "x_cells")
    both = left.join(sets.withColumnRenamed("id", "y"), "y")
    common = F.size(F.array_intersect("x_cells", "cells"))
    share = (common / (F.size("x_cells") + F.size("cells") - common)).alias("similarity")
    return both.select("x", "y", share).groupBy("x", "y").agg(F.max("similarity").alias("similarity"))


def _common(cells: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of cells that each row of ``a`` shares with each row of ``b``."""
    sizes = [len(c) for c in cells]
    row = np.repeat(np.arange(len(cells)), sizes)
    _, column_, count = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    column_ = place[column_]
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(column_, kind="stable")
    row, column_ = row[order], column_[order]
    for first in range(0, len(shared), BLOCK_CELLS):
        lo, hi = np.searchsorted(column_, [first, first + BLOCK_CELLS])
        has = np.zeros((len(cells), min(BLOCK_CELLS, len(shared) - first)), np.float32)
        has[row[lo:hi], column_[lo:hi] - first] = 1
        out += has[a] @ has[b].T
    return out


def _forest(a: np.ndarray, b: np.ndarray, part: np.ndarray) -> list[int]:
    """Places of the links (a, b) that join what the links before them have not joined."""
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for i, (x, y) in enumerate(zip(part[a].tolist(), part[b].tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(i)
    return out


def _links_in_blocks(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links ``x``, ``y`` that join all members of a bucket which are linked, directly or through others.

    ``members``: key, id, component, apart (not in the leader's component). The members of a bucket are
    dealt into blocks of about ``BLOCK``, those apart and the others separately, and every two blocks of
    which one at least is apart meet in one group, so a large bucket is spread over tasks; a bucket of one
    block's size is one group. The cells of ``sets`` join the members when these are dealt.
    """
    apart, near, one = F.count_if("apart"), F.count_if(~F.col("apart")), F.count("*") <= BLOCK
    sizes = members.groupBy("key").agg(
        F.when(one, 1).otherwise(F.ceil(apart / BLOCK)).cast("int").alias("n_apart"),
        F.when(one, 0).otherwise(F.ceil(near / BLOCK)).cast("int").alias("n_near"), one.alias("one"))
    dealt = _with_key(members, sizes)
    draw = F.xxhash64("id", "key")
    block = F.when(F.col("one"), 0).when(F.col("apart"), F.pmod(draw, F.col("n_apart"))).otherwise(
        F.col("n_apart") + F.pmod(draw, F.greatest("n_near", F.lit(1)))).cast("int")
    dealt = dealt.withColumn("block", block)
    others = F.when(F.col("apart"), F.sequence(F.lit(0), F.col("n_apart") + F.col("n_near") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("n_apart") - 1))
    dealt = dealt.withColumn("other", F.explode(others)).select(
        "key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "component")
    dealt = dealt.join(sets, "id")
    kind = members.schema["id"].dataType.simpleString()
    arrow_kind = to_arrow_type(members.schema["id"].dataType)

    def compared(rows: pd.DataFrame) -> tuple[list, list]:
        part, ids, block = (rows[c].to_numpy() for c in ("component", "id", "block"))
        a, b = np.flatnonzero(block == rows["p"].iloc[0]), np.flatnonzero(block == rows["q"].iloc[0])
        if not len(a) or not len(b):
            return [], []
        cells = rows["cells"].tolist()
        size = np.array([len(c) for c in cells])
        common = _common(cells, a, b)
        alike = common / (size[a][:, None] + size[b][None, :] - common) >= threshold - 1e-12
        i, j = np.nonzero(alike & (part[a][:, None] != part[b][None, :]))
        kept = _forest(a[i], b[j], part)
        return ids[a[i[kept]]].tolist(), ids[b[j[kept]]].tolist()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pd.DataFrame | None = None
        for batch in _with_end(batches):
            rows = [r for r in (rest, batch.to_pandas() if batch is not None else None) if r is not None]
            if not rows:
                continue
            rows = pd.concat(rows, ignore_index=True) if len(rows) > 1 else rows[0]
            keys = rows[["key", "p", "q"]].to_numpy()
            edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))[:len(rows)]
            stop = len(rows) if batch is None else int(edges[-1]) if len(edges) else 0
            xs, ys = [], []
            for a, b in zip(edges, [*edges[1:], len(rows)], strict=True):
                if b <= stop and b - a > 1:
                    x, y = compared(rows.iloc[a:b])
                    xs += x
                    ys += y
            rest = rows.iloc[stop:]
            yield pa.RecordBatch.from_arrays([pa.array(xs, arrow_kind), pa.array(ys, arrow_kind)], names=["x", "y"])

    ordered = dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return ordered.mapInArrow(tidy(compare), f"x {kind}, y {kind}")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_duplicates(df: DataFrame, identity: str, text: str, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS, weights: str = "count") -> DataFrame:
    """One row per row of ``df``: its id and ``class_id``, the smallest id of its class."""
    sketches = stage(sketched(df, identity, text, bands, rows, weights), "sketches")
    known = sketches.where("id is not null and print_a is not null")
    folded = stage(known.groupBy("print_a", "print_b").agg(F.min("id").alias("first")), "folded")
    firsts = known.join(folded.withColumnRenamed("first", "id"), ["print_a", "print_b", "id"], "left_semi")

    keyed = firsts.select("id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader <> last")
    members = stage(keyed.join(buckets.drop("last"), "key").where("id <> leader"), "members")
    led = stage(members.select(F.col("leader").alias("x"), F.col("id").alias("y")).distinct(), "pairs")
    sets = cell_sets(df, identity, text, led.select(F.col("x").alias("id")).union(led.select("y")), weights)
    checked = stage(similarities(led, sets), "checked")
    release(led)
    links = checked.where(F.col("similarity") >= threshold).select("x", "y")
    parts = stage(components(links, "x", "y"), "components")

    apart = _left_apart(members, checked, parts, threshold)
    count = apart.where("apart").count()
    if count:
        sets = stage(cell_sets(df, identity, text, apart.select("id"), weights), "cells")
    number = 0
    while count:
        pairs = _drawn_pairs(apart, number)
        links = stage(links.union(similarities(pairs, sets).where(F.col("similarity") >= threshold).select("x", "y")), "links")
        parts = stage(components(links, "x", "y"), "components")
        old, apart = apart, _left_apart(members, checked, parts, threshold)
        release(old)
        before, count, number = count, apart.where("apart").count(), number + 1
        if count > (1 - WORTH_A_ROUND) * before:
            break
    if count:
        links = stage(links.union(_links_in_blocks(apart, sets, threshold)), "links")
        parts = stage(components(links, "x", "y"), "components")
    release(members, checked, apart, sets, links)

    named = sketches.select("id", "print_a", "print_b").join(folded, ["print_a", "print_b"], "left")
    named = named.join(parts.withColumnRenamed("node", "first"), "first", "left")
    return named.select(F.col("id").alias(identity), F.coalesce("component", "first", "id").alias("class_id"))


def _with_key(rows: DataFrame, per_key: DataFrame) -> DataFrame:
    """Rows of buckets joined with one row per bucket, the rows of a large bucket being spread over ``SALTS`` tasks."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    copies = per_key.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(copies, ["key", "salt"]).drop("salt")


def _drawn_pairs(apart: DataFrame, number: int) -> DataFrame:
    """Each member that is left, with a member of its bucket drawn by a hash, if they differ in component."""
    drawn = apart.withColumn("draw", F.struct(F.xxhash64("id", "key", F.lit(number)), "id", "component"))
    leaders = drawn.groupBy("key").agg(F.min("draw").alias("drawn"))
    pairs = _with_key(apart, leaders).where(F.col("component") != F.col("drawn.component"))
    return pairs.select(F.least("id", "drawn.id").alias("x"), F.greatest("id", "drawn.id").alias("y")).distinct()


def _left_apart(members: DataFrame, checked: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """Members of buckets that the comparison with the leader has not settled: key, id, component, apart.

    With d = 1 - similarity, a member z apart from its leader can only be linked to a member y of the
    leader's component if |d(z, leader) - d(y, leader)| is at most 1 - threshold. How far y is from the
    leader is not bounded, as y may be in its component through others only.
    """
    reach = 1 - threshold + 1e-9
    ids = parts.withColumnRenamed("node", "id").withColumnRenamed("component", "own")
    leaders = parts.withColumnRenamed("node", "leader").withColumnRenamed("component", "lead")
    seen = checked.withColumnRenamed("x", "leader").withColumnRenamed("y", "id")
    rows = members.join(seen, ["leader", "id"]).join(ids, "id", "left").join(leaders, "leader", "left").select(
        "key", "id", "similarity", F.coalesce("own", "id").alias("component"),
        (F.coalesce("own", "id") != F.coalesce("lead", "leader")).alias("apart"))
    span = rows.where("apart").groupBy("key").agg(F.min("similarity").alias("low"), F.max("similarity").alias("top"))
    close = F.col("similarity").between(F.col("low") - reach, F.col("top") + reach)
    kept = stage(_with_key(rows, span).where(F.col("apart") | close).select("key", "id", "component", "apart"), "kept")
    met = kept.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    left = stage(_with_key(kept, met), "apart")
    release(kept)
    return left
