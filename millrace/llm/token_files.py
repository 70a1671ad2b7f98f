"""Token ids of whole documents in compressed, checksummed files, in ascending order of document id.

Documents are dealt out by ranges of their id, tokenised, and their ids, an end id behind each
document, are cut into blocks that the range coder codes one by one. A file is a Parquet file of
blocks: shard and block number, the coded ids with their number and CRC-32, and the documents that
begin in the block, with their lengths. Any block can be read alone; documents may span blocks.
Spark writes the files through its own committer, so a lost executor costs the repetition of its
shards and leaves no half-written ones.

Words are tokenised once and remembered up to a bound. That is exact for tokenizers that drop white
space, as the one used here does: no token reaches over it. For others pass ``apart=False``.

Rows of one id stand in order of their text; a null id comes first; a null text is an empty one, which
holds the end id only. An empty table makes no blocks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import range_coder
from millrace.llm.frames import column, tidy
from millrace.llm.pieces import _ranges
from millrace.llm.words import SPACED, _with_room, mixed, slices, words

BLOCK_FIELDS = ("shard int, block int, first long, size int, checksum long, payload binary, "
                "doc_ids array<{id}>, doc_sizes array<long>")
REMEMBERED_WORDS, LONGEST_REMEMBERED = 1 << 21, 64
WORDS_AT_ONCE = 64

#: A-Z are lower-cased, as the tokenizer does.
SPACED_LOWER = SPACED.copy()
SPACED_LOWER[ord("A"):ord("Z") + 1] += 32

#: Visible ASCII characters that are no capital letters.
PLAIN = np.zeros(256, bool)
PLAIN[0x21:0x7F] = True
PLAIN[ord("A"):ord("Z") + 1] = False

_REMEMBERED: dict[str, RememberedWords] = {}


class KnownWords:
    """Ids of words by their bytes, in arrays: a few dozen bytes a word where a dict of Python values takes hundreds.

    ``slots`` holds the number of a word at the first free place from its hash on. Words are the same if their
    bytes are, whatever their hashes. All are forgotten when there are too many.
    """

    def __init__(self, most_words: int = REMEMBERED_WORDS):
        self.most_words = most_words
        self._forget()

    def _forget(self) -> None:
        self.count = self.held = self.spelt = 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.hash, self.begin, self.length = np.empty(1 << 12, np.uint64), np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int32)
        self.start, self.size = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int32)
        self.letters, self.flat = np.empty(1 << 16, np.uint8), np.empty(1 << 16, np.uint32)

    def places(self, data: np.ndarray, bounds: np.ndarray, encode) -> np.ndarray:
        """Where ``start`` and ``size`` have the ids in ``flat`` of different words, which are ``data`` between ``bounds``.

        ``encode`` gives the flat ids of the words of some numbers, in any order, and the first place and number of each word's.
        """
        count, length = len(bounds) - 1, np.diff(bounds)
        if self.count + count > self.most_words or max(self.held // 8, self.spelt // 32) > self.most_words:
            self._forget()
        out = np.full(count, -1, np.int64)
        short = np.flatnonzero(length <= LONGEST_REMEMBERED)
        begin, length = bounds[short], length[short]
        letters = data if len(short) == count else data[_ranges(begin, length)]
        hashed = _hashed(letters, length)
        out[short] = self._found(hashed, letters, np.cumsum(length) - length, length)
        new = np.flatnonzero(out < 0)
        if len(new):
            flat, start, size = encode(new)
            at = self.count + np.arange(len(new))
            total = self.held + len(flat)
            self.flat = _with_room(self.flat, self.held, total)
            self.flat[self.held:total] = flat
            self.hash, self.begin, self.length, self.start, self.size = (
                _with_room(a, self.count, self.count + len(new)) for a in (self.hash, self.begin, self.length, self.start, self.size))
            self.start[at], self.size[at] = self.held + start, size
            out[new] = at
            self.count, self.held = self.count + len(new), total
            # Long words are encoded each time; their numbers hold for this call.
            fresh = np.flatnonzero(np.isin(short, new, assume_unique=True))
            self._add(out[short[fresh]], hashed[fresh], letters[_ranges((np.cumsum(length) - length)[fresh], length[fresh])], length[fresh])
        return out

    def _found(self, hashed: np.ndarray, letters: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.full(len(hashed), -1, np.int64)
        mask = len(self.slots) - 1
        open_, slot = np.arange(len(hashed)), (hashed & np.uint64(mask)).astype(np.int64)
        while len(open_):
            known = self.slots.take(slot)
            taken = known >= 0
            open_, slot, known = open_[taken], slot[taken], known[taken]
            like = np.flatnonzero((self.hash.take(known) == hashed[open_]) & (self.length.take(known) == length[open_]))
            same = np.zeros(len(open_), bool)
            if len(like):
                own, size = open_[like], length[open_[like]]
                equal = self.letters.take(_ranges(self.begin.take(known[like]), size)) == letters.take(_ranges(begin[own], size))
                same[like] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
            out[open_[same]] = known[same]
            open_, slot = open_[~same], slot[~same] + 1 & mask
        return out

    def _add(self, at: np.ndarray, hashed: np.ndarray, letters: np.ndarray, length: np.ndarray) -> None:
        total = self.spelt + len(letters)
        self.letters = _with_room(self.letters, self.spelt, total)
        self.letters[self.spelt:total] = letters
        self.hash[at], self.begin[at], self.length[at] = hashed, self.spelt + np.cumsum(length) - length, length
        self.spelt = total
        if 2 * self.count > len(self.slots):
            every = self.slots[self.slots >= 0]
            self.slots = np.full(1 << int(4 * self.count).bit_length() - 1, -1, np.int32)
            at = np.concatenate([every, at])
        at = at.astype(np.int32)
        mask = len(self.slots) - 1
        slot = (self.hash.take(at) & np.uint64(mask)).astype(np.int64)
        while len(at):
            free = self.slots.take(slot) < 0
            self.slots[slot[free]] = at[free]
            left = self.slots.take(slot) != at
            at, slot = at[left], slot[left] + 1 & mask


def _hashed(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64 bits of each word's bytes; no word is empty."""
    if not len(length):
        return np.empty(0, np.uint64)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
    factor = mixed(np.arange(LONGEST_REMEMBERED, dtype=np.uint64)) | np.uint64(1)
    parts = (letters.astype(np.uint64) + np.uint64(1)) * factor.take(place)
    return mixed(np.add.reduceat(parts, np.cumsum(length) - length))


def _leaves_plain_words(normalizer: dict | None) -> bool:
    """Whether a tokenizer's normaliser certainly leaves ``PLAIN`` words with single blanks between them as they are."""
    if normalizer is None:
        return False
    if normalizer["type"] == "Sequence":
        return all(map(_leaves_plain_words, normalizer["normalizers"]))
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    return normalizer["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or normalizer == blanks


class RememberedWords:
    """A tokenizer with the ids of the words it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        # Normalising takes a quarter of the time of a word that it leaves as it is.
        self.plain = None
        if _leaves_plain_words(json.loads(self.tokenizer.to_str())["normalizer"]):
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = None
            # Letters of the tokens, without the mark of the end of a word.
            mark = getattr(self.plain.model, "end_of_word_suffix", None) or ""
            self.length = np.ones(self.plain.get_vocab_size(), np.int64)
            for token, number in self.plain.get_vocab().items():
                self.length[number] = len(token.removesuffix(mark))
        self.memory = KnownWords()

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(i) for i in ids], np.int64)
        return np.fromiter((x for i in ids for x in i), np.uint32, int(size.sum())), size

    def encoded_plain(self, words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``PLAIN`` words, whose ids are told apart by the lengths of their tokens; by offsets where these do not spell the words."""
        texts = [" ".join(words_[a:a + WORDS_AT_ONCE]) for a in range(0, len(words_), WORDS_AT_ONCE)]
        flat: list[int] = []
        for first in range(0, len(texts), 64):
            for e in self.plain.encode_batch_fast(texts[first:first + 64], add_special_tokens=False):
                flat += e.ids
        ids = np.array(flat, np.uint32)
        length = self.length.take(ids)
        ends, stops = np.cumsum(length), np.cumsum([len(w) for w in words_])
        if not length.all() or not np.array_equal(ends[-1:], stops[-1:]):
            return self.encoded_words(words_)
        last = np.searchsorted(ends, stops)  # the last id of each word
        if (ends[last] != stops).any():
            return self.encoded_words(words_)
        return ids, np.diff(last, prepend=-1)

    def encoded_words(self, words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words with blanks between them in texts of ``WORDS_AT_ONCE``; an id is of the word in which it begins."""
        groups = [words_[a:a + WORDS_AT_ONCE] for a in range(0, len(words_), WORDS_AT_ONCE)]
        flat, size = [], []
        for first in range(0, len(groups), 64):
            some = groups[first:first + 64]
            encoded = self.tokenizer.encode_batch([" ".join(g) for g in some], add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for g in some for w in g])
            before = 0
            begins = []
            for group, e in zip(some, encoded, strict=True):
                begins += [before + a for a, _ in e.offsets]
                before += sum(map(len, group)) + len(group)
                flat += e.ids
            size.append(np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(ends)))
        return np.array(flat, np.uint32), np.concatenate(size)

    def of_slice(self, part, lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of a slice and their number."""
        found = words(part, SPACED_LOWER if lower else SPACED)
        if not len(found):
            return np.empty(0, np.uint32), np.zeros(len(part), np.int64)
        _, offsets, data = found.dictionary.buffers()
        bounds = np.frombuffer(offsets, np.int64)[found.dictionary.offset:found.dictionary.offset + len(found.dictionary) + 1]
        letters = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        whole = letters.tobytes().replace(b"\xff", b"\0")

        plain = np.logical_and.reduceat(PLAIN[letters], bounds[:-1]) & (self.plain is not None)

        def encode(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            flat, place, size = [], [], []
            for encoded, some in ((self.encoded_plain, np.flatnonzero(plain[numbers])), (self.encoded_words, np.flatnonzero(~plain[numbers]))):
                if len(some):
                    edges = zip(bounds[numbers[some]].tolist(), bounds[numbers[some] + 1].tolist(), strict=True)
                    ids, count = encoded([whole[a:b].decode() for a, b in edges])
                    flat.append(ids)
                    place.append(some)
                    size.append(count)
            sizes, order = np.concatenate(size), np.argsort(np.concatenate(place))
            return np.concatenate(flat), (np.cumsum(sizes) - sizes)[order], sizes[order]

        at = self.memory.places(letters, bounds, encode)[found.index]
        size = self.memory.size[at]
        return self.memory.flat[_ranges(self.memory.start[at], size)], np.bincount(found.row, size, len(part)).astype(np.int64)


def _tokenised(values: pa.Array, path: str, apart: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if path not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[path] = RememberedWords(path)
    memory = _REMEMBERED[path]
    if apart:
        # Special tokens are written between angle brackets and bars, and are matched in their own letter case.
        marked = bool(pc.any(pc.match_substring(values, "<|")).as_py())
        for part in slices(values, 4 << 20):
            yield memory.of_slice(part, not marked)
    else:
        for first in range(0, len(values), 256):
            yield memory.encoded([t or "" for t in values.slice(first, 256).to_pylist()])


def _with_ends(flat: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with an end id behind each document."""
    out = np.full(len(flat) + len(sizes), end_id, flat.dtype)
    stops = np.cumsum(sizes).tolist()
    for i, (a, b) in enumerate(zip([0, *stops], stops, strict=False)):
        out[a + i:b + i] = flat[a:b]
    return out


class _Writer:
    """Gathers the ids of one shard and hands them on as rows of blocks."""

    def __init__(self, shard: int, id_type: pa.DataType):
        self.shard, self.id_type = shard, id_type
        self.waiting: list[np.ndarray] = []
        self.count = self.place = self.block = 0
        self.docs: list[tuple[int, object, int]] = []  # place, id and size of documents not handed on yet
        self.next_place = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, doc_ids: list) -> None:
        self.waiting.append(ids)
        self.count += len(ids)
        for doc, size in zip(doc_ids, sizes.tolist(), strict=True):
            self.docs.append((self.next_place, doc, size))
            self.next_place += size

    def rows(self, final: bool) -> Iterator[pa.RecordBatch]:
        group = range_coder.GROUP * range_coder.BLOCK
        while self.count >= group or (final and self.count):
            ids = np.concatenate(self.waiting)
            now, rest = ids[:group], ids[group:]
            self.waiting, self.count = [rest], len(rest)
            blocks = [now[a:a + range_coder.BLOCK] for a in range(0, len(now), range_coder.BLOCK)]
            coded = range_coder.encode(blocks)
            starts = [self.place + a for a in range(0, len(now), range_coder.BLOCK)]
            heads: list[list] = [[] for _ in blocks]
            sizes: list[list] = [[] for _ in blocks]
            for at, (place, doc, size) in enumerate(self.docs):
                if place >= self.place + len(now):
                    self.docs = self.docs[at:]
                    break
                heads[(place - self.place) // range_coder.BLOCK].append(doc)
                sizes[(place - self.place) // range_coder.BLOCK].append(size)
            else:
                self.docs = []
            yield pa.RecordBatch.from_arrays([
                pa.array([self.shard] * len(blocks), pa.int32()), pa.array(range(self.block, self.block + len(blocks)), pa.int32()),
                pa.array(starts, pa.int64()), pa.array([c.size for c in coded], pa.int32()),
                pa.array([c.checksum for c in coded], pa.int64()), pa.array([c.payload for c in coded], pa.binary()),
                pa.array(heads, pa.list_(self.id_type)), pa.array(sizes, pa.list_(pa.int64()))],
                names=["shard", "block", "first", "size", "checksum", "payload", "doc_ids", "doc_sizes"])
            self.place += len(now)
            self.block += len(blocks)


def write(df: DataFrame, identity: str, text: str, path: str, tokenizer: str, end_id: int | None = None, apart: bool = True) -> None:
    """Write the ids of all documents below ``path``; ``tokenizer`` is the path of a tokenizer's JSON file."""
    base = df.select(column(df, identity).alias("id"), column(df, text).alias("text"))
    ordered = base.repartitionByRange("id").sortWithinPartitions("id", "text")
    fields = BLOCK_FIELDS.format(id=base.schema["id"].dataType.simpleString())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            writer = writer or _Writer(TaskContext.get().partitionId(), batch.schema.field("id").type)
            at = 0
            for flat, sizes in _tokenised(batch.column("text"), tokenizer, apart):
                if end_id is not None:
                    flat, sizes = _with_ends(flat, sizes, end_id), sizes + 1
                writer.add(flat, sizes, batch.column("id").slice(at, len(sizes)).to_pylist())
                at += len(sizes)
                yield from writer.rows(final=False)
        if writer:
            yield from writer.rows(final=True)

    ordered.mapInArrow(tidy(blocks), fields).write.parquet(path)


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def documents(blocks: DataFrame, fields: str, digest) -> DataFrame:
    """One row per document of token files, made from its id, the number of ids before it, and its ids.

    ``digest(doc_ids, starts, sizes, ids)`` makes the arrays of the DDL ``fields`` for some whole
    documents; ``ids`` are the ids of all of them, one document after the other. Blocks are checked
    against their checksums. Shards are read by one task each, in bounded groups of blocks.
    """
    totals = blocks.groupBy("shard").agg(F.sum("size").alias("total"))
    # One row per shard: shards are as many as the tasks that wrote them.
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    placed = blocks.join(F.broadcast(before), "shard").repartitionByRange("shard").sortWithinPartitions("shard", "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        open_docs: list[tuple] = []
        rest = np.empty(0, np.uint32)
        shard, place = None, 0
        for batch in batches:
            names = names or [f.name for f in schema.fields]
            for first in range(0, len(batch), range_coder.GROUP):
                part = batch.slice(first, range_coder.GROUP)
                rows = {n: part.column(n).to_pylist() for n in ("shard", "size", "checksum", "before", "doc_ids", "doc_sizes")}
                coded = [range_coder.Block(p.as_py(), s, c) for p, s, c in
                         zip(part.column("payload"), rows["size"], rows["checksum"], strict=True)]
                ids = range_coder.decode(coded)
                edges = [i for i, s in enumerate(rows["shard"]) if i == 0 or s != rows["shard"][i - 1]] + [len(ids)]
                for a, b in zip(edges, edges[1:], strict=False):
                    if rows["shard"][a] != shard:
                        if open_docs or len(rest):
                            raise ValueError(f"shard {shard} is not whole")
                        shard, place = rows["shard"][a], rows["before"][a]
                    open_docs += [d for i in range(a, b) for d in zip(rows["doc_ids"][i], rows["doc_sizes"][i], strict=True)]
                    rest = np.concatenate([rest, *ids[a:b]])
                    sizes = np.array([s for _, s in open_docs], np.int64)
                    whole = int(np.searchsorted(np.cumsum(sizes), len(rest), "right"))
                    if whole:
                        sizes = sizes[:whole]
                        starts = place + np.cumsum(sizes) - sizes
                        total = int(sizes.sum())
                        doc_ids = pa.array([d for d, _ in open_docs[:whole]], batch.schema.field("doc_ids").type.value_type)
                        yield pa.RecordBatch.from_arrays(digest(doc_ids, starts, sizes, rest[:total]), names=names)
                        rest, place, open_docs = rest[total:], place + total, open_docs[whole:]
        if open_docs or len(rest):
            raise ValueError(f"shard {shard} is not whole")

    schema = T.StructType.fromDDL(fields)
    return placed.mapInArrow(tidy(read), schema)
