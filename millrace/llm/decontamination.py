"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one suffix automaton: each state stands for word
sequences that end at the same places of the items, and a suffix link leads to the longest sequence
that ends at more places. Training text is streamed through it word by word; the state and the
longest matching length say at every word how much of an item ends there. A match of ``window`` or
more words hits its last ``window`` words, which together are every word inside an occurrence of an
item window. An item of fewer words, but not none, counts as one window.

A word pair that no item holds resets the match to a single word, so only runs of item pairs are
walked; numpy finds these runs for a whole slice of texts.

The automaton is built by Spark tasks, one per block of items. A block has about ``block_words``
item words, which bounds what one task builds; more items make more blocks. All blocks pass through the
driver one by one and are then held together by every Python worker, so the size of the benchmark is
limited by the memory of a worker (README.md has figures).

Nulls and texts without words match nothing. Items without words are ignored, rows of one item id
are one item, and items whose id is null hit words but are not listed.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import append, column, quoted, unused
from millrace.llm.words import ALPHANUMERIC, Texts, Words, slices, text_bytes, words

WINDOW = 10
BLOCK_WORDS = 1_000_000


class SuffixAutomaton:
    """Generalised suffix automaton over the numbers of an own dictionary of words, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        items = [(item, [self.number.setdefault(w, len(self.number)) for w in seq]) for item, seq in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(item, seq) for item, seq in items if seq]
        for _, seq in items:
            last = 0
            for symbol in seq:
                last = self._extend(last, symbol)
        self.shortest = min((min(len(seq), window) for _, seq in items), default=window)
        self.listed: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        for item, seq in items:
            state = 0
            for place, symbol in enumerate(seq, 1):
                state = self.next[state][symbol]
                if place >= window:
                    self.listed.setdefault(self._holding(state, window), set()).add(item)
            if len(seq) < window:
                marks = self.short.setdefault(self._holding(state, len(seq)), {})
                marks.setdefault(len(seq), set()).add(item)
        pairs = [p for _, seq in items for p in zip(seq, seq[1:], strict=False)]
        at = np.array(pairs, np.int64).reshape(-1, 2)
        self.pairs = np.unique(at[:, 0] * len(self.number) + at[:, 1])

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, parent: int, symbol: int, child: int) -> int:
        """The state of the parent's sequences plus ``symbol``, taken out of ``child`` if that holds longer ones."""
        if self.length[child] == self.length[parent] + 1:
            return child
        copy = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(symbol) == child:
            self.next[parent][symbol] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol, self.next[last][symbol])
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, symbol, self.next[at][symbol])
        return new

    def _holding(self, state: int, size: int) -> int:
        """The state, here or up the links, that stands for the last ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def walk(self, sequence: list[int], found: set[str | None]) -> list[tuple[int, int]]:
        """Hit ranges of a word sequence, in order and joined; adds the items whose windows occur to ``found``."""
        hits: list[tuple[int, int]] = []
        state = matched = 0
        for place, symbol in enumerate(sequence, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol not in self.next[state]:
                continue
            state, matched = self.next[state][symbol], matched + 1
            reach = 0
            if matched >= self.window:
                reach = self.window
                found |= self.listed.get(self._holding(state, reach), set())
            if self.short:
                up = state
                while up > 0:
                    for size, items in self.short.get(up, {}).items():
                        if size <= matched:
                            reach = max(reach, size)
                            found |= items
                    up = self.link[up]
            if reach:
                start = place - reach
                while hits and hits[-1][1] >= start:
                    start = min(start, hits.pop()[0])
                hits.append((start, place))
        return hits

    def scan(self, found: Words, rows: int) -> tuple[dict[int, list[tuple[int, int]]], list[set[str | None]]]:
        """Per row the hit ranges (positions among all words of the slice) and the items found."""
        hits: dict[int, list[tuple[int, int]]] = {}
        items: list[set[str | None]] = [set() for _ in range(rows)]
        if not self.number or not len(found):
            return hits, items
        at = np.array([self.number.get(w, -1) for w in found.distinct], np.int64)[found.index]
        known = at >= 0
        joined = known[:-1] & known[1:] & (found.row[:-1] == found.row[1:])
        places = np.flatnonzero(joined)
        keys = at[places] * len(self.number) + at[places + 1]
        joined[places] = np.isin(keys, self.pairs)
        begins = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        ends = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
        for a, b in zip(begins[ends - begins >= self.shortest], ends[ends - begins >= self.shortest], strict=True):
            row = int(found.row[a])
            for x, y in self.walk(at[a:b].tolist(), items[row]):
                hits.setdefault(row, []).append((int(a) + x, int(a) + y))
        return hits, items


def _item_words(texts: pd.Series) -> list[list[bytes]]:
    out: list[list[bytes]] = []
    for part in slices(pa.array(texts, pa.large_string())):
        found = words(part, ALPHANUMERIC)
        edges = np.searchsorted(found.row, np.arange(len(part) + 1))
        out += [[found.distinct[i] for i in found.index[a:b]] for a, b in zip(edges, edges[1:], strict=False)]
    return out


def automata(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
             block_words: int = BLOCK_WORDS) -> list:
    """One broadcast automaton per block of items; the number of blocks follows from the bytes of the items."""
    items = benchmark.select(column(benchmark, item_id).cast("string").alias("item"),
                             column(benchmark, item_text).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // (5 * block_words))  # a word and its separator take two bytes at least, mostly five and more
    spark = benchmark.sparkSession

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["item", "text"])
        made = SuffixAutomaton(list(zip(group["item"].where(group["item"].notna(), None), _item_words(group["text"]),
                                        strict=True)), window)
        return pd.DataFrame({"automaton": [pickle.dumps(made)]})

    out = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        rows = part.groupBy(F.lit("block").alias("block")).applyInPandas(build, "automaton binary").collect()
        out += [spark.sparkContext.broadcast(bytes(row.automaton)) for row in rows]
    return out


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


MATCH_FIELDS = "n_words long, hit_words array<struct<start: long, stop: long>>, hit_items array<string>"


def find_matches(df: DataFrame, text: str, blocks: list, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with its number of words, hit ranges (word positions, joined) and ids of the items hit.

    ``blocks`` comes from ``automata``. Ids are sorted as text. Columns of the same names are replaced.
    """
    out = df.drop("n_words", "hit_words", "hit_items")
    for number, block in enumerate(blocks or [None]):
        last = number == max(0, len(blocks) - 1)
        out = append(out, MATCH_FIELDS, _matcher(block, text), drop=drop if last else ())
    return out


def _matcher(block, text: str):
    def make():
        automaton = pickle.loads(block.value) if block is not None else SuffixAutomaton([], WINDOW)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            names = batch.schema.names
            before = batch.select(["hit_words", "hit_items"]).to_pylist() if "hit_words" in names else None
            counts, ranges, ids = [], [], []
            for part in slices(batch.column(text)):
                found = words(part, ALPHANUMERIC)
                hits, items = automaton.scan(found, len(part))
                edges = np.searchsorted(found.row, np.arange(len(part) + 1))
                counts += np.diff(edges).tolist()
                for row in range(len(part)):
                    ranges.append([(a - int(edges[row]), b - int(edges[row])) for a, b in hits.get(row, [])])
                    ids.append({i for i in items[row] if i is not None})
            if before:
                ranges = [r + [(x["start"], x["stop"]) for x in b["hit_words"]] for r, b in zip(ranges, before, strict=True)]
                ids = [i | set(b["hit_items"]) for i, b in zip(ids, before, strict=True)]
            structs = [[{"start": a, "stop": b} for a, b in _joined(r)] for r in ranges]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            return [pa.array(counts, pa.int64()), pa.array(structs, kind), pa.array([sorted(i) for i in ids], pa.list_(pa.string()))]

        return work

    return make


def _without(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges and what stands between them; one blank closes each gap."""
    part = text_bytes(pa.array([text], pa.large_string()))
    found = words(Texts(part.data, part.bounds, 0), ALPHANUMERIC)
    data, keep, at = part.data.tobytes(), [], 0
    for a, b in ranges:
        keep.append(data[at:int(found.start[a])])
        at = int(found.end[b - 1])
    return b" ".join([*keep, data[at:]]).decode()


def remove_matches(df: DataFrame, text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
                   window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without the matching spans; a document whose share of hit words exceeds ``max_coverage`` goes.

    Clean documents keep their text byte for byte, and all other columns stay. Taking a span out
    closes the text around it; should that make a new match, it is taken out as well.
    """
    blocks = automata(benchmark, item_id, item_text, window, block_words)

    def make():
        machines = [pickle.loads(b.value) for b in blocks]

        def hits_of(part: Texts, found: Words) -> dict[int, list[tuple[int, int]]]:
            hits: dict[int, list[tuple[int, int]]] = {}
            for machine in machines:
                for row, ranges in machine.scan(found, len(part))[0].items():
                    hits.setdefault(row, []).extend(ranges)
            return {row: _joined(ranges) for row, ranges in hits.items()}

        def clean(value: str, ranges: list[tuple[int, int]]) -> str:
            while ranges:
                value = _without(value, ranges)
                part = text_bytes(pa.array([value], pa.large_string()))
                ranges = hits_of(part, words(part, ALPHANUMERIC)).get(0, [])
            return value

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            changed: dict[int, str] = {}
            kept = np.ones(len(batch), bool)
            for part in slices(batch.column(text)):
                found = words(part, ALPHANUMERIC)
                edges = np.searchsorted(found.row, np.arange(len(part) + 1))
                for row, ranges in hits_of(part, found).items():
                    place = part.first + row
                    if sum(b - a for a, b in ranges) > max_coverage * (edges[row + 1] - edges[row]):
                        kept[place] = False
                    else:
                        own = [(a - int(edges[row]), b - int(edges[row])) for a, b in ranges]
                        changed[place] = clean(batch.column(text)[place].as_py(), own)
            if not changed:
                return [batch.column(text), pa.array(kept)]
            values = batch.column(text).to_pylist()
            for place, value in changed.items():
                values[place] = value
            return [pa.array(values, batch.schema.field(text).type), pa.array(kept)]

        return work

    clean_name = unused(df, "clean")
    cleaned = append(df, f"{quoted(text)} string, {quoted(clean_name)} boolean", make).where(F.col(quoted(clean_name)))
    return cleaned.select(*[F.col(quoted(c)) for c in df.columns])
