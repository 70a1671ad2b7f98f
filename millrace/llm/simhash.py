"""SimHash near-duplicates: fingerprints, and an inverted index of their positional bytes.

A fingerprint has 64 bits; a bit is 1 if it is set in more than half of the hashes of a document's shingles,
repeats included. Documents are linked if their fingerprints differ in at most ``MOST_BITS`` bits, and
classes are the connected components of all links.

Two bits lie in two bytes at most, so two linked fingerprints have at least 6 of their 8 positional bytes in
common. A list of the inverted index holds the fingerprints that have some bytes in the same places. One half
of a pair's bytes has at most one that differs, so the pair meets in a list of three bytes of one half. In
each list the bytes that a pair shares are tallied, pairs with fewer than 6 go, and the others are verified.
(Lists of single bytes would hold 1/256 of all fingerprints each, and pairs would grow with their square.)

Lists of more than ``LONG_LIST`` fingerprints are not compared as they are: their members go into lists of
six bytes, in 28 choices, one of which holds any pair that shares six. Such a list has at most 65,536 members,
however many documents there are, because only two bytes are free; there every fingerprint looks up those that
differ in one or two of these 16 bits. Nothing is capped, and a list hands on its components, never its pairs.

Edge cases: a document of one or two words is one shingle; one without words (null, empty) has the fingerprint
0, which is linked like any other. Rows of the same fingerprint are linked. A null id has a fingerprint and
links others, but names no component; a component of null ids only has a null name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import append, column, tidy
from millrace.llm.words import slices
from millrace.session import stage

SHINGLE, SEED = 3, 42
MOST_BITS, BYTES = 2, 8
LEAST_SHARED = BYTES - MOST_BITS
LONG_LIST = 1024
#: Hashes whose bits are counted at a time.
TALLIED = 1 << 14

#: The bytes of each kind of list: three of one half, or six of all.
SHORT_KEYS = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
LONG_KEYS = list(combinations(range(BYTES), LEAST_SHARED))


def _fingerprint(text: bytes, size: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-size] + 1]).tolist()
    stops = stops[size - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(stops), TALLIED):
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at:at + TALLIED], stops[at:at + TALLIED], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(stops), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text: str, size: int = SHINGLE, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with ``fingerprint``, its 64 bits as a signed number. A-Z are lower-cased, words stand between ASCII white space."""

    def make():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            prints = []
            for part in slices(batch.column(text)):
                edges = part.bounds.tolist()
                prints += [_fingerprint(part.data[a:b].tobytes(), size) for a, b in zip(edges, edges[1:])]
            return [pa.array(np.array(prints, np.uint64).view(np.int64))]

        return work

    return append(df, "fingerprint long", make, drop)


def _mask(places: tuple[int, ...]) -> int:
    """The bytes at some places, as a signed number."""
    return int.from_bytes(bytes(255 if i in places else 0 for i in range(BYTES)), "little", signed=True)


def _listed(prints: DataFrame, keys: list[tuple[int, ...]]) -> DataFrame:
    """``list``, ``value`` (the bytes in its places), ``fingerprint`` and ``least``, one row for each kind of list."""
    entries = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fingerprint").bitwiseAND(F.lit(_mask(places))).alias("value"))
                        for i, places in enumerate(keys)])
    return prints.select("fingerprint", "least", F.explode(entries).alias("entry")).select("entry.list", "entry.value", "fingerprint", "least")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of pairs that share enough positional bytes, verified by the bits that differ."""
    differ = x ^ y
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    enough = np.flatnonzero(shared >= LEAST_SHARED)
    return enough[np.bitwise_count(differ[enough]) <= MOST_BITS]


def _pairs_by_offset(prints: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of places i < j with j at most last[i], the end of the list that i is in."""
    a, b = [], []
    left, offset = np.arange(len(prints)), 1
    while len(left := left[left + offset <= last[left]]):
        near = left[_near(prints[left], prints[left + offset])]
        a.append(near)
        b.append(near + offset)
        offset += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _pairs_by_lookup(prints: np.ndarray, places: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of a list whose members are alike but for two bytes: the 16 bits are looked up with each change."""
    free = [i for i in range(BYTES) if i not in places]
    whole = prints.view(np.uint8).reshape(-1, BYTES)
    short = whole[:, free[0]].astype(np.int64) | whole[:, free[1]].astype(np.int64) << 8
    holder = np.full(1 << 16, -1)
    holder[short] = np.arange(len(prints))
    a, b = [], []
    for n in range(1, MOST_BITS + 1):
        for bits in combinations(range(16), n):
            other = holder[short ^ sum(1 << i for i in bits)]
            met = np.flatnonzero(other >= 0)
            a.append(met)
            b.append(other[met])
    return np.concatenate(a), np.concatenate(b)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place that links lead to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _links(lists: DataFrame, keys: list[tuple[int, ...]]) -> DataFrame:
    """``x``, ``y``: each linked fingerprint of a list with the first one of its component there."""

    def linked(index: np.ndarray, prints: np.ndarray, begins: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
        edges = np.append(begins, stop)
        size = np.diff(edges)
        short = size <= LONG_LIST
        last = np.repeat(np.where(short, edges[1:] - 1, -1), size)
        found = [_pairs_by_offset(prints[:stop], last)]
        for i in np.flatnonzero(~short).tolist():
            at, to = int(edges[i]), int(edges[i + 1])
            a, b = _pairs_by_lookup(prints[at:to], keys[index[at]])
            found.append((a + at, b + at))
        a, b = (np.concatenate(p) for p in zip(*found, strict=True))
        root = _roots(stop, a, b)
        moved = np.flatnonzero(root != np.arange(stop))
        return root[moved], moved

    def node(batch: pa.Table, places: np.ndarray) -> pa.Array:
        least = batch.column("least").combine_chunks().take(pa.array(places))
        prints = batch.column("fingerprint").combine_chunks().take(pa.array(places))
        return pa.StructArray.from_arrays([least.is_null(), least, prints], ["nameless", "least", "fingerprint"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in _with_end(batches):
            new = [] if batch is None else [pa.Table.from_batches([batch])]
            if not new and rest is None:
                continue
            table = pa.concat_tables([*([rest] if rest is not None else []), *new])
            index, value, prints = (table.column(c).to_numpy() for c in ("list", "value", "fingerprint"))
            head = np.ones(len(index), bool)
            head[1:] = (np.diff(index) != 0) | (value[1:] != value[:-1])
            begins = np.flatnonzero(head)
            stop = len(index) if batch is None else int(begins[-1]) if len(begins) else 0
            if stop:
                x, y = linked(index, prints.view(np.uint64), begins[begins < stop], stop)
                if len(x):
                    yield pa.RecordBatch.from_arrays([node(table, x), node(table, y)], names=["x", "y"])
            rest = table.slice(stop)

    kind = lists.schema["least"].dataType.simpleString()
    made = f"struct<nameless: boolean, least: {kind}, fingerprint: long>"
    dealt = lists.repartition("list", "value").sortWithinPartitions("list", "value")
    return dealt.mapInArrow(tidy(compare), f"x {made}, y {made}")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(prints: DataFrame) -> DataFrame:
    """Links that join all fingerprints which differ in at most two bits.

    ``prints``: different ``fingerprint``, each with ``least``, the smallest id that has it. Nodes sort by that id,
    those without one last, so the smallest node of a component names it.
    """
    lists = _listed(prints, SHORT_KEYS)
    long = stage(lists.groupBy("list", "value").count().where(F.col("count") > LONG_LIST).select("list", "value"), "long-lists")
    short = _links(lists.join(long, ["list", "value"], "left_anti"), SHORT_KEYS)
    if long.isEmpty():
        return short
    members = lists.join(long, ["list", "value"], "left_semi").select("fingerprint", "least").distinct()
    return short.union(_links(_listed(members, LONG_KEYS), LONG_KEYS))


def near_duplicates(df: DataFrame, identity: str, text: str, size: int = SHINGLE) -> DataFrame:
    """One row per row of ``df``: its id, ``fingerprint`` as 16 hexadecimal digits, ``component_id``."""
    base = df.select(column(df, identity).alias("id"), column(df, text).alias("text"))
    prints = stage(fingerprints(base, "text", size, drop=("text",)), "fingerprints")
    known = stage(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "known")
    parts = stage(components(links(known), "x", "y"), "components")
    moved = parts.select(F.col("node.fingerprint").alias("fingerprint"), F.col("component.least").alias("smallest"), F.lit(True).alias("linked"))
    # Written, so that the last join has a shuffle on either side, which adaptive execution can split at a hot fingerprint.
    named = stage(known.join(moved, "fingerprint", "left").select(
        "fingerprint", F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("least")).alias("component_id")), "named")
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(named, "fingerprint").select(F.col("id").alias(identity), hexadecimal.alias("fingerprint"), "component_id")
