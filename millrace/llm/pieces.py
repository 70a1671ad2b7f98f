"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Texts are read as words that begin with their blanks (U+2581 in the pieces). Only distinct words are
encoded. A word is cut wherever two neighbouring characters stand together in no piece, since no
piece can cover that place; the distinct parts of (nearly) equal length then advance together, one
character at a time. At each end position all substrings up to the longest piece are hashed from
running sums, the hashes probe the sorted piece keys, and a vectorised maximum over the candidates
stores the backpointers.

What is maximised depends on the kind of model. A unigram model takes the best sum of scores. A BPE
model has exactly one valid segmentation: its merge order makes two neighbouring pieces either
compatible or not, and a segmentation is the one that merging yields if all neighbours are
compatible. A candidate counts 1 if it is compatible with the last piece before it, else 0, so the
same maximum finds it. Both give the ids of the SentencePiece library.

Characters without a piece become byte pieces, or the unknown piece if the model has none. As in the
library, a literal U+2581 reads as a blank, an empty or null text has no ids, and decoding drops the
blank that encoding puts in front. Models whose normaliser rewrites characters are refused.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.frames import append, give_back
from millrace.llm.words import Remembered, mixed, numbered, slices, words

BLANK = "▁"
SLICE = 1 << 20
#: Rows encoded at a time: ids, texts and what checking takes are held beside the remembered words for so many only.
ROWS = 512
CELLS = 1 << 16
WORDS_AT_ONCE = 1 << 14
REMEMBERED_WORDS = 1 << 19
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0

SPACE = np.arange(256, dtype=np.uint8)
SPACE[0], SPACE[ord(" ")] = 0xFF, 0

_BASE = 0x9E3779B97F4A7C15 | 1
_NEVER = np.iinfo(np.int64).max


#: How bytes that make no valid character are decoded: as the library does, each by itself.
EACH_BYTE = "millrace-each-byte"
codecs.register_error(EACH_BYTE, lambda error: ("\ufffd", error.start + 1))


@lru_cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(length, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return table(_BASE), table(pow(_BASE, -1, 1 << 64))


def _prefix_hashes(points: np.ndarray) -> np.ndarray:
    """Running sums over the last axis, from which every substring gets its hash."""
    values = mixed(points.astype(np.uint64)) * _powers(1 << max(10, points.shape[-1].bit_length()))[0][:points.shape[-1]]
    out = np.zeros((*points.shape[:-1], points.shape[-1] + 1), np.uint64)
    np.cumsum(values, axis=-1, out=out[..., 1:])
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def merged(text: str, rank: dict[str, int]) -> list[tuple[str, int, int]]:
    """BPE by plain merging, for building tables: the final parts, and the cut of the last merge of each (0: none)."""
    parts = [(c, 0, 0) for c in text]
    while len(parts) > 1:
        best, at = min(((rank.get(a[0] + b[0], _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
        if best == _NEVER:
            break
        parts[at:at + 2] = [(parts[at][0] + parts[at + 1][0], len(parts[at][0]), 0)]
    return parts


@dataclass
class PieceModel:
    """Tables of a model; everything is as large as its vocabulary."""

    pieces: list[str]
    scores: np.ndarray
    kind: int
    unknown: int
    byte_ids: np.ndarray | None
    dummy_prefix: bool
    normal: np.ndarray  # whether a piece takes part in segmentation
    controls: np.ndarray  # whether a piece is decoded to nothing
    keys: np.ndarray = field(init=False)
    key_pieces: np.ndarray = field(init=False)

    def __post_init__(self):
        used = np.flatnonzero(self.normal)
        self.longest = max((len(self.pieces[i]) for i in used), default=1)
        keys = np.array([mixed(_prefix_hashes(_code_points(self.pieces[i]))[-1:])[0] for i in used], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_pieces = keys[order], used[order]
        self.present = np.zeros(1 << 20, bool)
        self.present[keys >> np.uint64(44)] = True
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.points = np.zeros((len(self.pieces), self.longest), np.uint32)
        for i in used:
            self.points[i, :self.lengths[i]] = _code_points(self.pieces[i])
        text = [_code_points(self.pieces[i]).astype(np.uint64) for i in used]
        self.bigrams = np.unique(np.concatenate([t[:-1] << np.uint64(32) | t[1:] for t in text] or [np.empty(0, np.uint64)]))
        self.inner_blanks = any(BLANK in self.pieces[i].lstrip(BLANK) for i in used)
        self.lowest = float(self.scores[used].min()) if len(used) else 0.0
        if self.kind == BPE:
            self._merge_tables(used)
        self._decode_tables()

    def _merge_tables(self, used: np.ndarray) -> None:
        """Rank, and left and right part by the last merge, of each piece; all pairs that could merge."""
        order = used[np.argsort(-self.scores[used], kind="stable")]
        _, level = np.unique(-self.scores[used], return_inverse=True)
        size = len(self.pieces)
        self.rank = np.full(size + 1, -1, np.int64)  # the last place is a character without a piece
        self.rank[used] = level
        index = {self.pieces[i]: int(i) for i in order[::-1]}
        ranks = {p: int(self.rank[i]) for p, i in index.items() if len(p) > 1}
        self.left, self.right = np.arange(size + 1), np.arange(size + 1)
        self.reachable = np.zeros(size + 1, bool)
        self.reachable[size] = True
        self.regular = True
        pairs: dict[int, int] = {}
        for piece, i in index.items():
            parts = merged(piece, ranks) if len(piece) > 1 else [(piece, 0, 0)]
            if len(parts) > 1:
                continue
            self.reachable[i] = True
            cut = parts[0][1]
            if cut:
                a, b = index.get(piece[:cut], size), index.get(piece[cut:], size)
                self.left[i], self.right[i] = a, b
                for part, text in ((a, piece[:cut]), (b, piece[cut:])):
                    if len(text) > 1 and self.rank[part] >= self.rank[i] and set(piece) != {BLANK}:
                        self.regular = False
            for cut in range(1, len(piece)):
                a, b = index.get(piece[:cut]), index.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * (size + 1) + b] = int(self.rank[i])
        single = np.array([len(p) == 1 for p in self.pieces] + [True])
        self.rank[single] = -1  # characters are there from the start
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.ranks = ranks
        self.index = index

    def _decode_tables(self) -> None:
        raw = []
        byte_of = {int(i): b for b, i in enumerate(self.byte_ids)} if self.byte_ids is not None else {}
        for i, piece in enumerate(self.pieces):
            if i in byte_of:
                raw.append(bytes([byte_of[i]]))
            elif i == self.unknown:
                raw.append(" ⁇ ".encode())
            else:
                raw.append(b"" if self.controls[i] else piece.replace(BLANK, " ").encode())
        sizes = np.array([len(r) for r in raw] or [0])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.leads = np.array([bool(n) and p.startswith(BLANK) for n, p in zip(self.normal, self.pieces, strict=True)])
        self.raw_start, self.raw_size = np.cumsum(sizes) - sizes, sizes

    def find(self, hashes: np.ndarray, points: np.ndarray, length: int) -> np.ndarray:
        """Piece of each substring of ``length`` characters, by its hash, -1 if there is none.

        Hash i is that of the characters from place i // rows on in row i % rows of ``points``; what a hash finds
        is compared character by character.
        """
        keys = mixed(hashes)
        out = np.full(len(keys), -1, np.int64)
        maybe = np.flatnonzero(self.present[keys >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        maybe, piece = maybe[hit], self.key_pieces[at[hit]]
        same = self.lengths[piece] == length
        place, row = np.divmod(maybe, len(points))
        for k in range(length):
            same &= points[row, place + k] == self.points[piece, min(k, self.longest - 1)]
        out[maybe[same]] = piece[same]
        return out

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves these two pieces side by side, pair by pair.

        Merges are taken back from the last to the first. As long as some pair at the border could have
        merged before the merge just taken back, that merge would have come first.
        """
        size = len(self.pieces) + 1
        pairs, back = np.unique(first * size + second, return_inverse=True)
        a, b = pairs // size, pairs % size
        good = self.reachable[a] & self.reachable[b]
        limit = np.full(len(a), _NEVER)
        live = np.flatnonzero(good)
        while len(live):
            x, y = a[live], b[live]
            key = x * size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1) if len(self.pair_keys) else None
            if at is not None:
                early = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit[live])
                good[live[early]] = False
                live, x, y = live[~early], x[~early], y[~early]
            undo_first = self.rank[x] > self.rank[y]
            undo_second = ~undo_first & (self.rank[y] >= 0)
            a[live] = np.where(undo_first, self.right[x], x)
            b[live] = np.where(undo_second, self.left[y], y)
            # Equal ranks merge from left to right, so a tie goes to the border only against the second piece.
            limit[live] = np.where(undo_first, self.rank[x], self.rank[y] + 1)
            live = live[undo_first | undo_second]
        return good[back]


def load(path: str) -> PieceModel:
    """Tables of a SentencePiece model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    return from_proto(proto)


def from_proto(proto) -> PieceModel:
    normaliser = proto.normalizer_spec
    if normaliser.precompiled_charsmap or normaliser.remove_extra_whitespaces or not normaliser.escape_whitespaces:
        raise ValueError("only models that leave characters and blanks as they are can be used")
    kind = proto.trainer_spec.model_type
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be used")
    pieces = [p.piece for p in proto.pieces]
    types = np.array([p.type for p in proto.pieces])  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
    if (types == 4).any():
        raise ValueError("models with user-defined pieces cannot be used")
    byte_ids = np.flatnonzero(types == 6)
    if len(byte_ids):
        byte_ids = byte_ids[np.argsort([int(pieces[i][1:-1], 16) for i in byte_ids])]
    return PieceModel(pieces, np.array([p.score for p in proto.pieces], np.float64), kind, int(np.flatnonzero(types == 2)[0]),
                      byte_ids if len(byte_ids) == 256 else None, normaliser.add_dummy_prefix, types == 1, types == 3)


def _segmented(model: PieceModel, points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Viterbi over the rows of a padded matrix of characters, of ``sizes`` characters each.

    Returns, from the last step back, the rows that have a piece there and the pieces; -1 - c stands
    for a character c without a piece.
    """
    rows, width = points.shape
    sums = _prefix_hashes(points)
    inverse = _powers(1 << max(10, width.bit_length()))[1]
    size, longest = len(model.pieces), min(model.longest, width)
    # The piece that ends at each place, by its start; the longest stands first, as ties go to it in the library.
    pieces = np.full((width + 1, longest, rows), -1, np.int32)
    for length in range(1, longest + 1):
        found = model.find(((sums[:, length:] - sums[:, :-length]) * inverse[:width + 1 - length]).T.reshape(-1), points, length)
        pieces[length:, longest - length] = found.reshape(width + 1 - length, rows)
    single = pieces[1:, longest - 1]
    single[single < 0] = size
    best = np.full((width + 1, rows), -np.inf)
    best[0] = 0 if model.kind == UNIGRAM else 1
    last = np.full((width + 1, rows), size, np.int32)
    back = np.zeros((width + 1, rows), np.int32)
    scores = np.append(model.scores, model.lowest - UNKNOWN_PENALTY)
    for end in range(1, width + 1):
        first = max(0, end - longest)
        here = pieces[end, longest - (end - first):]
        place, row = np.nonzero((here >= 0) & (sizes >= end))
        piece, start = here[place, row].astype(np.int64), first + place
        value = np.full(here.shape, -np.inf)
        if model.kind == BPE:
            good = (best[start, row] > 0) & model.reachable[piece]
            inner = np.flatnonzero(good & (start > 0) & (piece < size))
            good[inner] = model.compatible(last[start[inner], row[inner]].astype(np.int64), piece[inner])
            value[place, row] = good
        else:
            value[place, row] = best[start, row] + scores[piece]
        top = value.argmax(axis=0)
        every = np.arange(rows)
        best[end], last[end], back[end] = value[top, every], here[top, every], first + top
    out = []
    at, live = sizes.copy(), np.arange(rows)
    while len(live):
        piece, start = last[at[live], live].astype(np.int64), back[at[live], live]
        out.append((live, np.where(piece == size, -1 - points[live, start].astype(np.int64), piece)))
        at[live] = start
        live = live[start > 0]
    return out


def _lists(parts: list[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat pieces in reading order and the number of pieces of each row."""
    row = np.concatenate([p[0] for p in parts])
    piece = np.concatenate([p[1] for p in parts])
    step = np.concatenate([np.full(len(p[0]), -i) for i, p in enumerate(parts)])
    order = np.lexsort((step, row))
    return piece[order], np.bincount(row, minlength=rows)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def _expanded(model: PieceModel, piece: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their number per row, with byte pieces in place of characters without a piece."""
    odd = np.flatnonzero(piece < 0)
    if not len(odd):
        return piece, counts
    width = np.ones(len(piece), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    if model.byte_ids is None:
        piece = piece.copy()
        piece[odd] = model.unknown
        return piece, counts
    encoded = {int(c): chr(-1 - c).encode("utf-8", "surrogatepass") for c in np.unique(piece[odd])}
    width[odd] = [len(encoded[int(c)]) for c in piece[odd]]
    out = np.repeat(piece, width)
    starts = np.cumsum(width) - width
    places = _ranges(starts[odd], width[odd])
    out[places] = model.byte_ids[np.frombuffer(b"".join(encoded[int(c)] for c in piece[odd]), np.uint8)]
    return out, np.bincount(owner, width, len(counts)).astype(np.int64)


def encode_words(model: PieceModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and number of ids of texts in which U+2581 stands for blanks."""
    joined = _code_points("".join(texts))
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(joined):
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    wide = joined.astype(np.uint64)
    pairs = wide[:-1] << np.uint64(32) | wide[1:]
    cut = np.ones(len(joined), bool)
    cut[1:] = (owner[1:] != owner[:-1]) | ~np.isin(pairs, model.bigrams)
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, len(joined)))
    part_of, parts = numbered(joined.view(np.uint8), 4 * size)
    first = np.zeros(len(parts), np.int64)
    first[part_of[::-1]] = np.arange(len(part_of))[::-1]
    part_start, part_size = start[first], size[first]
    ids, counts = [], np.zeros(len(first), np.int64)
    order = np.argsort(part_size, kind="stable")
    at, flat_order = 0, []
    while at < len(order):
        n = int(part_size[order[at]])
        width = n if n <= 24 else 1 << (n - 1).bit_length()
        same = int(np.searchsorted(part_size[order], width, "right"))
        stop = min(same, at + max(1, CELLS // width))
        rows = order[at:stop]
        width = int(part_size[rows].max())
        matrix = np.zeros((len(rows), width), np.uint32)
        inside = np.arange(width) < part_size[rows][:, None]
        matrix[inside] = joined[_ranges(part_start[rows], part_size[rows])]
        piece, number = _lists(_segmented(model, matrix, part_size[rows]), len(rows))
        piece, number = _expanded(model, piece, number)
        ids.append(piece)
        counts[rows] = number
        flat_order.append(rows)
        at = stop
    flat = np.concatenate(ids)
    begin = np.zeros(len(first), np.int64)
    ordered = np.concatenate(flat_order)
    begin[ordered] = np.cumsum(counts[ordered]) - counts[ordered]
    return (flat[_ranges(begin[part_of], counts[part_of])],
            np.bincount(owner[start], counts[part_of], len(texts)).astype(np.int64))


class Encoder:
    """Encodes columns of texts and remembers the words it has met, up to a bound."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.memory = Remembered(self._encoded, REMEMBERED_WORDS)

    @staticmethod
    def _key(gap: int, word: bytes) -> bytes:
        """A word and the blanks before it as bytes, which take half the memory of a pair; no word holds byte 0."""
        return word if gap == 1 else b"%d\0%s" % (gap, word)

    @staticmethod
    def _text(key: bytes) -> str:
        gap, mark, word = key.partition(b"\0")
        return BLANK * (int(gap) if mark else 1) + (word if mark else gap).replace(b"\xff", b"\0").decode().replace(" ", BLANK)

    def _encoded(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with some blanks before them."""
        texts = [self._text(key) for key in keys]
        if self.model.kind == BPE and not self.model.regular:
            plain = [[p[0] for p in merged(t, self.model.ranks)] for t in texts]
            flat = np.array([self.model.index.get(p, -1 - ord(p)) if len(p) == 1 else self.model.index[p] for t in plain for p in t], np.int64)
            return _expanded(self.model, flat, np.array([len(t) for t in plain]))
        made = [encode_words(self.model, texts[a:a + WORDS_AT_ONCE]) for a in range(0, len(texts), WORDS_AT_ONCE)]
        flat, size = (np.concatenate(m) for m in zip(*made, strict=True))
        return flat, size

    @staticmethod
    def plain(column: pa.Array) -> pa.Array:
        """The texts with blanks in place of U+2581, as they are read."""
        column = column.cast(pa.large_string())
        return pc.replace_substring(column, BLANK, " ") if pc.any(pc.match_substring(column, BLANK)).as_py() else column

    def __call__(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Flat ids and number of ids per row, slice by slice."""
        return (self._slice(part) for part in slices(self.plain(column), SLICE))

    def _slice(self, part) -> tuple[np.ndarray, np.ndarray]:
        row, gap, index, distinct = self._units(part)
        span = int(gap.max(initial=0)) + 1
        which, pairs = pd.factorize(index.astype(np.int64) * span + gap)
        word, blanks = np.divmod(pairs, span)
        keys = [self._key(g, distinct[i]) for i, g in zip(word.tolist(), blanks.tolist(), strict=True)]
        at = self.memory.places(keys)[which]
        size = self.memory.size[at]
        return self.memory.flat[_ranges(self.memory.start[at], size)], np.bincount(row, size, len(part)).astype(np.int64)

    def _units(self, part) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Row of each word, the number of blanks before it and its number among the distinct words; trailing blanks are an empty word."""
        rows, begin, end = len(part), part.bounds[:-1], part.bounds[1:]
        lead = int(self.model.dummy_prefix)
        if self.model.inner_blanks:  # a piece may reach over blanks, so a text is one word
            text = words(part, np.maximum(SPACE, np.where(np.arange(256) == 32, 32, 0).astype(np.uint8)))
            return text.row, np.full(len(text), lead), text.index, text.distinct
        found = words(part, SPACE)
        before = np.empty(len(found), np.int64)
        fresh = np.ones(len(found), bool)
        fresh[1:] = found.row[1:] != found.row[:-1]
        before[fresh] = begin[found.row[fresh]] - lead
        before[~fresh] = found.end[:-1][~fresh[1:]]
        gap = found.start - before
        counts = found.per_row(rows)
        final = np.searchsorted(found.row, np.arange(rows), "right") - 1
        stop = np.where(counts > 0, found.end[final] if len(found) else 0, begin - lead)
        rest = np.flatnonzero((end > begin) & (end > stop))
        if not len(rest):
            return found.row, gap, found.index, found.distinct
        where = np.searchsorted(found.row, rest, "right")
        empty = len(found.distinct)
        return (np.insert(found.row, where, rest), np.insert(gap, where, (end - stop)[rest]), np.insert(found.index, where, empty),
                [*found.distinct, b""])


def encode(df: DataFrame, text: str, model: PieceModel, ids: str = "token_ids", verified: str | None = None,
           drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with the ids of each text as an array.

    ``verified`` names a boolean column that says whether decoding the ids gave the text back. Columns
    of these names are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        encoder = Encoder(sent.value)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            give_back()
            values = encoder.plain(batch.column(text)).fill_null("")
            flat, sizes, same, at = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], [], 0
            for own, size in encoder(values):
                if verified:  # slice by slice, so that only one decoded text of a slice is held
                    same.append(pc.equal(decoded(encoder.model, own, size), values.slice(at, len(size))))
                    at += len(size)
                flat.append(own.astype(np.int32, copy=False))
                sizes.append(size)
            offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
            out = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))]
            if verified:
                out.append(pa.chunked_array(same, pa.bool_()).combine_chunks())
            return out

        return work

    return append(df, f"`{ids}` array<int>" + (f", `{verified}` boolean" if verified else ""), make, drop, ROWS)


def decoded(model: PieceModel, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Texts of rows of ids; bytes that make no valid character become U+FFFD, as in the library."""
    if len(flat) and (flat.min() < 0 or flat.max() >= len(model.pieces)):
        raise ValueError("an id lies outside the vocabulary")
    begins = np.cumsum(sizes) - sizes
    skip = np.zeros(len(flat), np.int64)
    width = model.raw_size[flat]
    if model.dummy_prefix:
        shown = np.append(np.flatnonzero(width), len(flat))
        head = shown[np.searchsorted(shown, begins)]  # the first piece of each row that is shown
        head = head[head < begins + sizes]
        skip[head[model.leads[flat[head]]]] = 1
    width = width - skip
    data = model.raw[_ranges(model.raw_start[flat] + skip, width)]
    total = np.concatenate([[0], np.cumsum(width)])
    offsets = total[np.concatenate([begins, [len(flat)]])]
    made = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    try:
        return made.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([value.decode("utf-8", EACH_BYTE) for value in made.to_pylist()], pa.large_string())


def decode(df: DataFrame, ids: str, model: PieceModel, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with the text of each array of ids (null: empty); a column of that name is replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            lists, out = batch.column(ids), []
            for first in range(0, len(batch), 512):
                part = lists.slice(first, 512)
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                out.append(decoded(own, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes))
            return [pa.chunked_array(out, pa.large_string()).combine_chunks().cast(pa.string()) if out else pa.array([], pa.string())]

        return work

    return append(df, f"`{text}` string", make, drop)
