"""Words of whole Arrow text columns as numpy arrays, without a Python string per word.

A text is read as its UTF-8 bytes. A 256-entry table says which bytes separate words and how the
others are normalised, so a word is a run of bytes that are not separators. The words of a slice are
numbered by a dictionary of their normalised bytes, so two words have one number exactly if they are the
same. Where words of different slices have to meet, each different word of a slice is hashed to 64 bits
(XXH3); operators whose results must be exact look words up by their bytes instead.

Nulls are empty texts. Work goes through slices of about ``SLICE_BYTES``; only a single longer text
makes a longer slice, and its bytes too are looked at piece by piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 19


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _separated(separators: bytes, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A"):ord("Z") + 1] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


def _bytes_of(*ranges: tuple[int, int]) -> bytes:
    return bytes(b for first, last in ranges for b in range(first, last + 1))


#: Words are what stands between ASCII white space; letter case is kept.
SPACED = _separated(_bytes_of((0x20, 0x20), (0x09, 0x0D)), lower=False)
SPACED[0] = 0xFF  # byte 0 belongs to a word; 0xFF never occurs in UTF-8
#: A-Z are lower-cased; words are runs of a-z, 0-9 and everything beyond ASCII.
ALPHANUMERIC = _separated(_bytes_of((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)), lower=True)
#: A-Z are lower-cased; words are runs of a-z and everything beyond ASCII.
LETTERS = _separated(_bytes_of((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)), lower=True)


class Texts(NamedTuple):
    """UTF-8 bytes of some rows; row i holds ``data[bounds[i]:bounds[i + 1]]``. ``first`` is its row in the batch."""

    data: np.ndarray
    bounds: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words in order of rows and places: byte range, row, and number in the dictionary of different normalised words."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    index: np.ndarray
    dictionary: pa.Array

    def __len__(self) -> int:
        return len(self.row)

    @cached_property
    def distinct(self) -> list[bytes]:
        return self.dictionary.to_pylist()

    @cached_property
    def hash(self) -> np.ndarray:
        """64 bits of each word's normalised bytes, the same in every slice."""
        return np.array([xxhash.xxh3_64_intdigest(w) for w in self.distinct], np.uint64)[self.index]

    def per_row(self, rows: int) -> np.ndarray:
        return np.bincount(self.row, minlength=rows)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64), 0)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(whole[bounds[0]:bounds[-1]], bounds - bounds[0], 0)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a column in slices of at most ``limit`` bytes, or of one row if that is longer."""
    data, bounds, _ = text_bytes(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield Texts(data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first], first)
        first = last


def _pieces(texts: Texts, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``SLICE_BYTES`` that end behind a separator or at the end of the data."""
    at, size = 0, len(texts.data)
    while at < size:
        stop = min(size, at + SLICE_BYTES)
        while stop < size:
            breaks = np.flatnonzero(table[texts.data[at:stop]] == 0)
            if breaks.size:
                stop = at + int(breaks[-1]) + 1
                break
            stop = min(size, stop + SLICE_BYTES)
        yield at, stop
        at = stop


def words(texts: Texts, table: np.ndarray) -> Words:
    parts = [_words_of_piece(texts, table, at, stop) for at, stop in _pieces(texts, table)]
    if not parts:
        return Words(*(np.empty(0, np.int64) for _ in range(4)), pa.array([], pa.large_binary()))
    start, end, flat = (np.concatenate(p) if len(parts) > 1 else p[0] for p in zip(*parts, strict=True))
    return Words(start, end, np.searchsorted(texts.bounds, start, "right") - 1, *numbered(flat, end - start))


def _words_of_piece(texts: Texts, table: np.ndarray, at: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a piece, and the normalised bytes of all of them."""
    norm = table[texts.data[at:stop]]
    inside = norm != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    inner = texts.bounds[np.searchsorted(texts.bounds, at, "left"):np.searchsorted(texts.bounds, stop, "left")] - at
    first[inner] |= inside[inner]  # a row begins here, whatever the row before ended with
    begins_next = np.zeros(len(norm), bool)
    begins_next[:-1] = first[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins_next[:-1]
    return np.flatnonzero(first) + at, np.flatnonzero(last) + 1 + at, norm[inside]


def numbered(flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each run of bytes in a dictionary of the different ones, which are numbered as they first occur; and that dictionary."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    coded = runs.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


class Remembered:
    """Ids of the words met so far in this Python worker, by their bytes; all are forgotten when there are too many.

    ``encode`` gives the flat ids of some words, and the number of ids of each. A word is remembered by a key
    that tells it apart from all others.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most_words: int, kind: type = np.int32):
        self.encode, self.most_words, self.kind = encode, most_words, kind
        self._forget()

    def _forget(self) -> None:
        self.place: dict = {}
        self.held = 0
        self.flat = np.empty(1 << 16, self.kind)
        self.start, self.size = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)

    def places(self, keys: list) -> np.ndarray:
        """Where ``start`` and ``size`` have the ids of each key in ``flat``."""
        if len(self.place) + len(keys) > self.most_words or self.held > 8 * self.most_words:
            self._forget()
        place = self.place
        out = np.array([place.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh = [keys[i] for i in new.tolist()]
            flat, size = self.encode(fresh)
            n, total = len(place), self.held + len(flat)
            self.flat = _with_room(self.flat, self.held, total)
            self.start, self.size = (_with_room(a, n, n + len(fresh)) for a in (self.start, self.size))
            self.flat[self.held:total] = flat
            self.start[n:n + len(fresh)] = self.held + np.cumsum(size) - size
            self.size[n:n + len(fresh)] = size
            out[new] = np.arange(n, n + len(fresh))
            place.update(zip(fresh, out[new].tolist(), strict=True))
            self.held = total
        return out


def _with_room(a: np.ndarray, used: int, wanted: int) -> np.ndarray:
    if wanted <= len(a):
        return a
    out = np.empty(max(wanted, 2 * len(a)), a.dtype)
    out[:used] = a[:used]
    return out


def runs_of_rows(row: np.ndarray, rows: int) -> np.ndarray:
    """Where the words of each row begin among all words, with their number at the end."""
    return np.searchsorted(row, np.arange(rows + 1))


def windows(found: Words, size: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``size`` words; a row with fewer words, but not none, is one run."""
    n = len(found)
    total = np.zeros(n, np.uint64)
    for j in range(min(size, n)):
        total[:n - j] += mixed(found.hash[j:] + np.uint64(j + 1))
    whole = np.zeros(n, bool)
    if n >= size:
        whole[:n - size + 1] = found.row[size - 1:] == found.row[:n - size + 1]
    counts = found.per_row(rows)
    begins = runs_of_rows(found.row, rows)
    short = np.flatnonzero((counts > 0) & (counts < size))
    for k in range(1, size):
        at = begins[short[counts[short] == k]]
        total[at] = 0
        for j in range(k):
            total[at] += mixed(found.hash[at + j] + np.uint64(j + 1))
    whole[begins[short]] = True
    picked = np.flatnonzero(whole)
    return mixed(total[picked]), found.row[picked]


def occurrence(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """0 for the first time a value stands in its row, 1 for the second, and so on."""
    order = np.lexsort((value, row))
    same = np.zeros(len(order), bool)
    same[1:] = (value[order][1:] == value[order][:-1]) & (row[order][1:] == row[order][:-1])
    index = np.arange(len(order))
    begins = np.maximum.accumulate(np.where(same, 0, index))
    out = np.empty(len(order), np.int64)
    out[order] = index - begins
    return out
