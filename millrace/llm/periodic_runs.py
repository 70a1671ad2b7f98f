"""Runs of words that repeat with a period, found by block convolution.

A run is a stretch of consecutive words, as long as it can be, in which words one period apart are equal;
its period is the smallest such number, and it holds at least ``EXPONENT`` periods and ``LEAST`` words.

Periods are searched for at dyadic scales. At scale B, for periods from B to 2B - 1, texts are cut into
blocks of B words. The first block that begins inside a run occurs again one period later, so it has an
occurrence in the 2B words that follow it. All shifts of a block along these words are compared at once: the
sum of squared differences of the word numbers is a convolution, which a number-theoretic transform gives
exactly, and it is 0 where the block occurs. The distances of occurrences seed the runs: blocks in a row
that occur at one distance form a chain, and a chain that is long enough is extended word by word.

What keeps the work small on any text: a block is skipped if one of its words does not come again soon
enough, or if the words it is compared with all lie in one run of a period that is found; a chain is skipped
if it is too short for a run of its distance, or lies in a run whose period divides its distance. None of
these can lose a run.

Word numbers are numbers of a dictionary of the words themselves, so different words never share one. Sums
are taken modulo as many primes as it takes for their product to exceed the largest sum.

Edge cases: texts without words (null, empty, white space) have no runs and collapse to an empty text. Ties,
repeated rows and null ids need no rule, since every text stands for itself. Texts are worked on in slices
of bounded size, or alone if longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.frames import append
from millrace.llm.words import slices

#: A run has at least so many words, and so many periods; the search needs 3 periods or more.
LEAST, EXPONENT = 6, 4
#: Numbers that one step of the transform works on at a time, unless a single block needs more.
CELLS = 1 << 18
#: Primes c * 2^k + 1, each with a generator of its multiplicative group.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
LONGEST_TRANSFORM = 1 << 26


@cache
def _roots(prime: int, generator: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a root of unity of order ``length``, and of its inverse, up to half the order."""
    root = pow(generator, (prime - 1) // length, prime)
    out = []
    for base in (root, pow(root, -1, prime)):
        powers = np.ones(max(1, length // 2), np.uint64)
        done = 1
        while done < len(powers):
            powers[done:2 * done] = powers[:done] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done *= 2
        out.append(powers)
    return out[0], out[1]


def _forward(a: np.ndarray, prime: int, powers: np.ndarray) -> None:
    """Transform of each row in place; the result stands in bit-reversed order."""
    p, (rows, length) = np.uint64(prime), a.shape
    half = length // 2
    while half:
        view = a.reshape(rows, -1, 2, half)
        u, v = view[:, :, 0], view[:, :, 1]
        difference = (u + (p - v)) * powers[::len(powers) // half][:half] % p
        both = u + v
        view[:, :, 0] = np.minimum(both, both - p)  # a negative number would wrap to a large one
        view[:, :, 1] = difference
        half //= 2


def _backward(a: np.ndarray, prime: int, powers: np.ndarray) -> None:
    """The inverse of ``_forward``, also in place."""
    p, (rows, length) = np.uint64(prime), a.shape
    half = 1
    while half < length:
        view = a.reshape(rows, -1, 2, half)
        u, v = view[:, :, 0].copy(), view[:, :, 1] * powers[::len(powers) // half][:half] % p
        both, other = u + v, u + (p - v)
        view[:, :, 0] = np.minimum(both, both - p)
        view[:, :, 1] = np.minimum(other, other - p)
        half *= 2
    a *= np.uint64(pow(length, -1, prime))
    a %= p


def squared_differences(blocks: np.ndarray, following: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Modulo the prime: sum over j of (following[r, t + j] - blocks[r, j])^2 for all shifts t below the block length."""
    rows, size = blocks.shape
    p, length = np.uint64(prime), 2 * size
    if length > LONGEST_TRANSFORM:
        raise ValueError(f"a text has more than {2 * LONGEST_TRANSFORM} words")
    powers, inverses = _roots(prime, generator, length)
    text = following.astype(np.uint64) % p
    mirrored = np.zeros_like(text)
    mirrored[:, -np.arange(size)] = blocks.astype(np.uint64) % p
    squares = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(text * text % p, axis=1, out=squares[:, 1:])
    own = (mirrored * mirrored % p).sum(axis=1, keepdims=True) % p
    _forward(text, prime, powers)
    _forward(mirrored, prime, powers)
    text *= mirrored
    text %= p
    _backward(text, prime, inverses)
    return (squares[:, size:length] - squares[:, :size] + own + np.uint64(2) * (p - text[:, :size])) % p


def _occurrences(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` of blocks and the distances, from size to 2 size - 1, at which they occur again before ``stops``."""
    found_at, found_distance = [], []
    step = max(1, CELLS // (2 * size))
    for at in range(0, len(starts), step):
        start, stop = starts[at:at + step], stops[at:at + step]
        blocks = ids[start[:, None] + np.arange(size)]
        place = start[:, None] + size + np.arange(2 * size)
        following = np.where(place < stop[:, None], ids[np.minimum(place, len(ids) - 1)], 0)
        row, shift = np.nonzero(squared_differences(blocks, following, *PRIMES[0]) == 0)
        reached, used = PRIMES[0][0], 1
        while len(row) and reached <= largest * largest * size:  # the sum could be a multiple of the primes so far
            some, place_of = np.unique(row, return_inverse=True)
            again = squared_differences(blocks[some], following[some], *PRIMES[used])
            zero = again[place_of, shift] == 0
            row, shift = row[zero], shift[zero]
            reached, used = reached * PRIMES[used][0], used + 1
        found_at.append(start[row])
        found_distance.append(shift + size)
    return np.concatenate(found_at), np.concatenate(found_distance)


def _equal_steps(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, room: np.ndarray, step: int, chunk: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``distance`` later; ``room`` at most."""
    out = np.zeros(len(at), np.int64)
    active = np.flatnonzero(room > 0)
    while len(active):
        left = []
        for part in np.array_split(active, max(1, len(active) * chunk // CELLS)):
            k = out[part][:, None] + np.arange(chunk)
            inside = k < room[part][:, None]
            place = np.where(inside, at[part][:, None] + step * k, 0)
            equal = inside & (ids[place] == ids[np.minimum(place + distance[part][:, None], len(ids) - 1)])
            run = np.where(equal.all(axis=1), chunk, equal.argmin(axis=1))
            out[part] += run
            left.append(part[run == chunk])
        active = np.concatenate(left)
    return out


def _next_distance(ids: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Distance to the next equal word of the same row; the number of all words where there is none."""
    order = np.lexsort((ids, row))
    out = np.full(len(ids), len(ids), np.int64)
    same = (ids[order][1:] == ids[order][:-1]) & (row[order][1:] == row[order][:-1])
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, ...]:
    """Row, start, length and period of every run, by row, start, period. Row i has the words from bounds[i] to bounds[i + 1].

    ``ids`` are positive numbers, equal for equal words.
    """
    if exponent < 3:
        raise ValueError("a run must hold three periods or more")
    total, sizes = len(ids), np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    largest = int(ids.max(initial=0))
    farthest = _next_distance(ids, row)  # over the words of a block that starts here
    in_run_until, in_run_of = np.zeros(total, np.int64), np.ones(total, np.int64)
    starts = stops = periods = np.empty(0, np.int64)
    size = 1
    while True:
        rows = np.flatnonzero(sizes >= max(least, exponent * size))
        if not len(rows):
            break
        count = sizes[rows] // size - 1  # a block must have room to occur again
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start, stop = np.repeat(bounds[rows], count) + nth * size, np.repeat(bounds[rows + 1], count)
        settled = (in_run_until[start] >= start + 3 * size - 1) & (in_run_of[start] <= size)
        open_ = (farthest[start] < 2 * size) & ~settled
        if open_.any():
            at, distance = _occurrences(ids, start[open_], stop[open_], size, largest)
            order = np.lexsort((at, distance))
            at, distance = at[order], distance[order]
            head = np.ones(len(at), bool)
            head[1:] = (np.diff(distance) != 0) | (np.diff(at) != size)
            first, last = at[head], at[np.append(head[1:], True)] if len(at) else at
            q = distance[head]
            needed = np.maximum(least, exponent * q) - q
            known = (in_run_until[first] >= last + size + q) & (q % in_run_of[first] == 0)
            kept = (last - first + 3 * size - 2 >= needed) & ~known
            first, last, q = first[kept], last[kept], q[kept]
            of = row[first]
            begin = first - _equal_steps(ids, first - 1, q, first - bounds[of], -1, size)
            end = last + size + q + _equal_steps(ids, last + size, q, bounds[of + 1] - (last + size + q), 1, size)
            long = end - begin >= np.maximum(least, exponent * q)
            begin, end, q = begin[long], end[long], q[long]
            # A stretch that is known already has a smaller period.
            new = ~np.isin(begin * (total + 1) + end, starts * (total + 1) + stops)
            begin, end, q = begin[new], end[new], q[new]
            _, once = np.unique(begin * (total + 1) + end, return_index=True)
            begin, end, q = begin[once], end[once], q[once]
            for b, e, period in zip(begin.tolist(), end.tolist(), q.tolist(), strict=True):
                further = np.flatnonzero(in_run_until[b:e] < e) + b
                in_run_until[further], in_run_of[further] = e, period
            starts, stops, periods = (np.concatenate(x) for x in ((starts, begin), (stops, end), (periods, q)))
        farthest[:total - size] = np.maximum(farthest[:total - size], farthest[size:])
        size *= 2
    of = row[starts] if total else starts
    order = np.lexsort((periods, starts))
    return of[order], (starts - bounds[of])[order], (stops - starts)[order], periods[order]


def kept_words(total: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each of ``total`` words stays: it lies in no run behind the run's first period. Starts count over all rows."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def spaced_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all rows in one array, and where those of each row begin and the last ends."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(flat), 0)
    parent = parent.filter(some).to_numpy()
    return flat.filter(some), np.searchsorted(parent, np.arange(len(texts) + 1))


def _found(texts: pa.Array, least: int, exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, runs, and text without what runs repeat, of each row."""
    words, bounds = spaced_words(texts)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    row, start, length, period = runs(ids, bounds, least, exponent)
    kept = np.flatnonzero(kept_words(len(ids), start + bounds[row], length, period))
    edges = np.searchsorted(kept, bounds)
    left = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), words.take(pa.array(kept)))
    structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32()), structs)
    return pa.array(np.diff(bounds), pa.int64()), lists, pc.binary_join(left, " ")


def find_runs(df: DataFrame, text: str, least: int = LEAST, exponent: int = EXPONENT,
              prepare: Callable[[pa.RecordBatch], pa.Array] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words stand between ASCII white space and are numbered from 0. ``collapsed`` has the words that no run
    holds behind its first period, joined by blanks. ``prepare`` may give other texts for the rows of a batch.
    """

    def make():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(text) if prepare is None else prepare(batch)
            parts: list[list[pa.Array]] = [[pa.array([], pa.int64())], [], []]
            parts[1].append(pa.array([], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))))
            parts[2].append(pa.array([], pa.string()))
            for part in slices(texts):
                for out, new in zip(parts, _found(texts.slice(part.first, len(part)), least, exponent), strict=True):
                    out.append(new)
            return [pa.concat_arrays(p) for p in parts]

        return work

    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return append(df, fields, make, drop)
