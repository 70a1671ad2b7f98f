"""Adaptive context-mixing range coder for ids, many streams in step.

A block is coded on its own: it lists the ids it holds, and its models start empty. At every place
three models predict the next id. The order-2 and order-1 contexts each name one id, with a
confidence that grows while they are right; the order-0 model has a share for every id of the block,
from the counts so far. The shares of the two named ids are the success rates that their confidences
have had in this block; what they leave is dealt out by order 0. The id is then coded in a single
step of a range coder with 64-bit state and 32-bit digits, whose carries are added at the end.

A block is cut into up to ``STREAMS`` sections that go in step, each with a range coder of its own, and
share the models of the block. These stand still for a few places and then learn from all ids that the
sections had there, so numpy does this for many places at once, and coding needs place by place no
more than the steps of the range coder. Reading a block goes place by place, for all sections of a
group of blocks at a time. Order-0 shares are renewed at places that lie further and further apart,
up to ``RENEWAL``. Only integers and exactly rounded products and quotients are used, so that a block
decodes to the same ids on any machine.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

STREAMS, SECTION = 64, 1024  # the most sections of a block, and the ids each of them has if there are fewer
BLOCK = 65536
GROUP = 128  # blocks that are coded in step
CHUNK = 16
RENEWAL = 1024
TOTAL_BITS, ZERO_BITS = 24, 16
SLOTS, LEVEL_BITS = 16384, 3
LEVELS = 1 << LEVEL_BITS
#: What a confidence loses when its context was wrong (first half) or gains when it was right.
STEP = np.array([-(s + 1 >> 1) for s in range(LEVELS)] + [int(s < LEVELS - 1) for s in range(LEVELS)], np.int32)
#: Whether an entry stays, and goes on by its step.
KEPT = np.array([s > 1 for s in range(LEVELS)] + [True] * LEVELS)
DIGIT, UNIT = np.uint64(32), np.uint64(TOTAL_BITS)
ONE_DIGIT, LOW_DIGIT = np.uint64(1 << 32), np.uint64((1 << 32) - 1)


class Block(NamedTuple):
    payload: bytes
    size: int
    checksum: int


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, seven bits each with the lowest first, and the number of bytes of each value."""
    values = values.astype(np.uint64)
    size = np.maximum(1, -(-np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64) // 7))
    owner = np.repeat(np.arange(len(values)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    part = (values[owner] >> (place * 7).astype(np.uint64)) & np.uint64(127)
    return (part | np.where(place < size[owner] - 1, 128, 0).astype(np.uint64)).astype(np.uint8), size


def _read_varints(data: np.ndarray, count: int) -> tuple[np.ndarray, int]:
    """The first ``count`` values and the number of bytes they take."""
    ends = np.flatnonzero(data[:count * 10] < 128)[:count]
    if len(ends) < count:
        raise ValueError("a block is damaged")
    stop = int(ends[-1]) + 1 if count else 0
    start = np.concatenate([[0], ends[:-1] + 1]) if count else np.empty(0, np.int64)
    owner = np.repeat(np.arange(count), ends + 1 - start)
    place = (np.arange(stop) - start[owner]).astype(np.uint64)
    out = np.zeros(count, np.uint64)
    np.add.at(out, owner, (data[:stop] & np.uint8(127)).astype(np.uint64) << (place * np.uint64(7)))
    return out, stop


class _Group:
    """Sections and models of the blocks of a group.

    Blocks are in order of falling length of their sections. Lanes are the sections in order of falling
    length; at a place the first ``active`` go on. The models of a block stand still for a chunk of places
    and then learn from the sections that have all of them.
    """

    def __init__(self, sizes: np.ndarray, alphabet: np.ndarray, decoding: bool):
        self.blocks, self.alphabet, self.width = len(sizes), alphabet, int(alphabet.max())
        streams, section = _sections(sizes)
        block = np.repeat(np.arange(self.blocks), streams)
        stream = np.arange(len(block)) - np.repeat(np.cumsum(streams) - streams, streams)
        length = np.minimum(section[block], sizes[block] - stream * section[block])
        order = np.argsort(-length, kind="stable")
        self.block, self.stream, self.length = block[order], stream[order], length[order]
        self.first = self.stream * section[self.block]
        self.places, self.lanes = int(self.length[0]), len(order)
        self.active = np.searchsorted(-self.length, -np.arange(self.places), "left").tolist()
        self.going_on = np.searchsorted(-section, -np.arange(self.places), "left").tolist()
        self.lane_level, self.lane_slot = self.block * LEVELS, self.block * SLOTS
        self.lane_width, self.lane_sums, self.lane_zero = self.block * self.width, self.block * (self.width + 1), self.block << ZERO_BITS
        self.counts, self.counted = np.zeros(self.blocks * self.width, np.int32), np.zeros(self.blocks, np.int64)
        self.beyond = np.arange(self.width) >= alphabet[:, None]
        # A context's entry is the named symbol times LEVELS plus its confidence; confidence 0 names nothing.
        self.entries2, self.entries1 = np.zeros(self.blocks * SLOTS, np.int32), np.zeros(self.blocks * self.width, np.int32)
        self.tried = np.zeros((2, self.blocks * LEVELS, 2), np.int64)  # by order and confidence: how often it was wrong and right
        self.sums = np.zeros((self.blocks, self.width + 1), np.int32)
        # The symbol at every place of the sums of order 0, which only decoding asks for.
        self.found = np.zeros(self.blocks << ZERO_BITS, np.uint16) if decoding else None
        self.pending: list[np.ndarray] = []
        self._renew_rates()
        self._renew_shares(self.blocks)

    def _renew_rates(self) -> None:
        # A confidence that has not been put to the test counts as right half of the time; 0 has no share. Order 0 keeps 1 in 256 for its 1 << ZERO_BITS.
        right = self.tried[:, :, 1]
        rate = np.minimum((right * 2 + 1 << TOTAL_BITS) // ((self.tried[:, :, 0] + right) * 2 + 2), (1 << TOTAL_BITS) * 15 // 16)
        rate[:, ::LEVELS] = 0
        self.rate2, self.rate1 = rate[0], rate[1] >> 8

    def _renew_shares(self, blocks: int) -> None:
        if self.pending:
            seen = np.concatenate([(self.lane_width[:p.shape[1]] + p).ravel() for p in self.pending])
            self.counts += np.bincount(seen, minlength=len(self.counts)).astype(np.int32)
            for p in self.pending:
                self.counted += np.bincount(self.block[:p.shape[1]], minlength=self.blocks) * len(p)
            self.pending = []
        ratio = ((1 << ZERO_BITS) - self.alphabet[:blocks]) / (self.counted[:blocks] * 32 + self.alphabet[:blocks])
        share = ((self.counts.reshape(self.blocks, -1)[:blocks] * 32 + 1) * ratio[:, None]).astype(np.int32)
        share += 1
        share[self.beyond[:blocks]] = 0
        # What rounding left over goes to the last symbol.
        share[np.arange(blocks), self.alphabet[:blocks] - 1] += (1 << ZERO_BITS) - share.sum(axis=1, dtype=np.int32)
        np.cumsum(share, axis=1, out=self.sums[:blocks, 1:])
        if self.found is not None:
            symbol = np.broadcast_to(np.arange(self.width, dtype=np.uint16), (blocks, self.width))
            self.found[:blocks << ZERO_BITS] = np.repeat(symbol.ravel(), share.ravel())

    def shares(self, entry2: np.ndarray, entry1: np.ndarray):
        """What the two contexts name, and their shares; one id has one share."""
        lane_level = self.lane_level[:entry2.shape[-1]]
        named2, named1 = entry2 >> LEVEL_BITS, entry1 >> LEVEL_BITS
        share2 = self.rate2.take((entry2 & (LEVELS - 1)) + lane_level)
        share1 = ((1 << TOTAL_BITS) - share2) * self.rate1.take((entry1 & (LEVELS - 1)) + lane_level) >> (TOTAL_BITS - 8)
        share1 *= (named1 != named2) | (share2 == 0)
        return named2, named1, share2, share1

    def learn(self, stop: int, renewed: bool, symbol: np.ndarray, place2: np.ndarray, place1: np.ndarray,
              entry2: np.ndarray, entry1: np.ndarray, given1: np.ndarray) -> None:
        """Learns from the symbols of the chunk that ends at ``stop``, with the contexts' places and entries.

        ``given1`` says where order 1 had a share, which counts if order 2 was not right. Of the places that share
        a context, the last one changes its entry.
        """
        m = self.active[stop - 1]
        lane_level = self.lane_level[:m]
        symbol = symbol[:, :m]
        self.pending.append(symbol)
        fresh = (symbol * LEVELS + 1).astype(np.int32)
        for order, entries, place, entry in ((0, self.entries2, place2[:, :m], entry2[:, :m]), (1, self.entries1, place1[:, :m], entry1[:, :m])):
            sure = entry & (LEVELS - 1)
            same = (entry - sure + 1 == fresh) & (sure > 0)
            step = sure + same * np.int32(LEVELS)
            level = (sure + lane_level) * 2 + same
            if order:
                level = level[tried]
            self.tried[order] += np.bincount(level.ravel(), minlength=self.blocks * LEVELS * 2).reshape(-1, 2)
            if not order:
                tried = given1[:, :m] & ~same
            entries[place] = np.where(KEPT.take(step), entry + STEP.take(step), fresh)
        self._renew_rates()
        if renewed:
            self._renew_shares(self.going_on[stop])


def _sections(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and length of the sections of blocks; the last section may be shorter."""
    streams = np.minimum(STREAMS, -(-sizes // SECTION))
    return streams, -(-sizes // streams)


def _chunks(places: int) -> Iterator[tuple[int, int, bool]]:
    """Ranges of places in which the models stand still, and whether the shares of order 0 are renewed behind them.

    They are the same for blocks of any length, but for the end of the last one.
    """
    at, renewal = 0, 4
    while at < places:
        stop = at + min(CHUNK, max(4, at // 8 * 4))
        renewed = stop >= renewal
        if renewed:
            renewal = stop + min(stop, RENEWAL)
        yield at, min(stop, places), renewed
        at = stop


def _context(older, last):
    return (older * 40503 + last * 769) & (SLOTS - 1)


def _in_groups(blocks: list, size: np.ndarray) -> Iterator[list[int]]:
    """Numbers of the blocks that are not empty, by groups in order of falling length of their sections."""
    full = np.flatnonzero(size)
    for first in range(0, len(full), GROUP):
        group = full[first:first + GROUP]
        yield group[np.argsort(-_sections(size[group])[1], kind="stable")].tolist()


def encode(blocks: list[np.ndarray]) -> list[Block]:
    """Code blocks of ids, each on its own; an empty block is one without bytes."""
    out = [Block(b"", 0, 0)] * len(blocks)
    for group in _in_groups(blocks, np.array([len(b) for b in blocks], np.int64)):
        for i, block in zip(group, _encode([blocks[i] for i in group]), strict=True):
            out[i] = block
    return out


def _encode(blocks: list[np.ndarray]) -> list[Block]:
    sizes = np.array([len(b) for b in blocks])
    numbered = [_numbered(b) for b in blocks]
    if max(len(own) for own, _ in numbered) > 1 << ZERO_BITS:
        raise ValueError("a block holds too many different ids")
    group = _Group(sizes, np.array([len(own) for own, _ in numbered]), decoding=False)
    lanes, places = group.lanes, group.places
    symbols = np.zeros((lanes, places + 2), np.int32)  # with two places before the first one
    for lane, (b, first, length) in enumerate(zip(group.block.tolist(), group.first.tolist(), group.length.tolist(), strict=True)):
        symbols[lane, 2:length + 2] = numbered[b][1][first:first + length]
    span = np.full(lanes, ~np.uint64(0))
    # The sums of what is added to each digit, whose carries are still to be taken to the digits before.
    digits, used = np.zeros((lanes, places + 2), np.uint64), np.zeros(lanes, np.int64)
    for first, stop, renewed in _chunks(places):
        m = group.active[first]
        known = np.ascontiguousarray(symbols[:m, first:stop + 2].T, np.int64)
        older, last, symbol = known[:-2], known[1:-1], known[2:]
        place2, place1 = group.lane_slot[:m] + _context(older, last), group.lane_width[:m] + last
        entry2, entry1 = group.entries2.take(place2), group.entries1.take(place1)
        named2, named1, share2, share1 = group.shares(entry2, entry1)
        hit2, hit1 = (named2 == symbol) & (share2 > 0), (named1 == symbol) & (share1 > 0)
        both = share2 + share1
        rest, at = (1 << TOTAL_BITS) - both, group.lane_sums[:m] + symbol
        below = rest * group.sums.take(at) >> ZERO_BITS
        width = (rest * group.sums.take(at + 1) >> ZERO_BITS) - below
        start = np.where(hit2, 0, np.where(hit1, share2, both + below)).astype(np.uint64)
        width = np.where(hit2, share2, np.where(hit1, share1, width)).astype(np.uint64)
        settled = np.zeros(start.shape, bool)
        for t, n in enumerate(group.active[first:stop]):
            now = span[:n]
            unit = now >> UNIT
            start[t, :n] *= unit
            start[t, n:] = 0
            np.multiply(unit, width[t, :n], out=now)
            now <<= np.less(now, ONE_DIGIT, out=settled[t, :n]) * DIGIT
        passed = np.cumsum(settled, axis=0)
        most = int(passed[-1].max()) + 2
        place = passed - settled + np.arange(m) * most
        added = np.bincount(place.ravel(), (start >> DIGIT).ravel(), m * most)
        added += np.bincount(place.ravel() + 1, (start & LOW_DIGIT).ravel(), m * most)[:m * most]
        digits.reshape(-1)[(np.arange(m) * (places + 2) + used[:m])[:, None] + np.arange(most)] += added.reshape(m, most).astype(np.uint64)
        used[:m] += passed[-1]
        if stop < places:
            group.learn(stop, renewed, symbol, place2, place1, entry2, entry1, share1 > 0)
    coded: list[list[bytes]] = [[b""] * STREAMS for _ in blocks]
    for lane, (b, stream, n) in enumerate(zip(group.block.tolist(), group.stream.tolist(), (used + 2).tolist(), strict=True)):
        low, high = (int.from_bytes(d.astype(">u4").tobytes()) for d in (digits[lane, :n] & LOW_DIGIT, digits[lane, :n] >> DIGIT))
        # Rounded up to a digit, which stays within the interval; the one behind it reads as zero.
        coded[b][stream] = (-(-(low + (high << 32)) >> 32)).to_bytes(4 * (n - 1))
    out = []
    for block, (own, _), parts in zip(blocks, numbered, coded, strict=True):
        lengths = [len(p) // 4 for p in parts if p]
        head = _varints(np.concatenate([[len(own)], np.diff(own.astype(np.int64), prepend=0), lengths]))[0]
        out.append(Block(head.tobytes() + b"".join(parts), len(block), checksum(block)))
    return out


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in ascending order, and the number of each id among them."""
    most = int(ids.max())
    if most >= 1 << 20:
        return np.unique(ids, return_inverse=True)
    number = np.zeros(most + 1, np.int32)
    number[ids] = 1
    own = np.flatnonzero(number)
    number[own] = np.arange(len(own))
    return own, number[ids]


def checksum(ids: np.ndarray, before: int = 0) -> int:
    """CRC-32 of the ids as unsigned 32-bit little-endian integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), before)


def decode(blocks: list[Block]) -> list[np.ndarray]:
    """The ids of each block; a block that fails its checksum raises."""
    out = [np.empty(0, np.uint32)] * len(blocks)
    for group in _in_groups(blocks, np.array([b.size for b in blocks], np.int64)):
        for i, ids in zip(group, _decode([blocks[i] for i in group]), strict=True):
            if checksum(ids) != blocks[i].checksum:
                raise ValueError("a block is damaged")
            out[i] = ids
    return out


def _parted(block: Block, streams: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different ids of a block, and the digits of its streams."""
    data = np.frombuffer(block.payload, np.uint8)
    count, at = _read_varints(data, 1)
    if not 0 < count[0] <= block.size:
        raise ValueError("a block is damaged")
    values, more = _read_varints(data[at:], int(count[0]) + streams)
    stops = np.cumsum(values[int(count[0]):].astype(np.int64))
    digits = data[at + more:]
    if len(digits) % 4 or (values[int(count[0]):] > len(digits)).any() or stops[-1] * 4 != len(digits):
        raise ValueError("a block is damaged")
    return np.cumsum(values[:int(count[0])]).astype(np.uint32), np.split(digits.view(">u4"), stops[:-1])


def _decode(blocks: list[Block]) -> list[np.ndarray]:
    sizes = np.array([b.size for b in blocks])
    parted = [_parted(b, n) for b, n in zip(blocks, _sections(sizes)[0].tolist(), strict=True)]
    group = _Group(sizes, np.array([len(own) for own, _ in parted]), decoding=True)
    lanes, places = group.lanes, group.places
    digits = np.zeros((lanes, max(len(s) for _, streams in parted for s in streams) + 2), np.uint32)
    for lane, (b, stream) in enumerate(zip(group.block.tolist(), group.stream.tolist(), strict=True)):
        own = parted[b][1][stream]
        digits[lane, :len(own)] = own
    span = np.full(lanes, ~np.uint64(0))
    code = digits[:, 0].astype(np.uint64) << DIGIT | digits[:, 1]
    # Where the next digit of each lane stands; a damaged block may read on in the next lane's.
    ahead = np.arange(lanes) * digits.shape[1] + 2
    digits = digits.ravel()
    symbols = np.zeros((places, lanes), np.int32)
    symbol, place2, place1 = (np.zeros((CHUNK, lanes), np.int64) for _ in range(3))
    entry2, entry1 = (np.zeros((CHUNK, lanes), np.int32) for _ in range(2))
    given1 = np.zeros((CHUNK, lanes), bool)
    older, last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    sums, found = group.sums.reshape(-1), group.found
    for first, stop, renewed in _chunks(places):
        for t, m in enumerate(group.active[first:stop]):
            older, last = older[:m], last[:m]
            at2 = np.add(group.lane_slot[:m], _context(older, last), out=place2[t, :m])
            at1 = np.add(group.lane_width[:m], last, out=place1[t, :m])
            now2 = group.entries2.take(at2, out=entry2[t, :m], mode="clip")
            now1 = group.entries1.take(at1, out=entry1[t, :m], mode="clip")
            named2, named1, share2, share1 = group.shares(now2, now1)
            both = share2 + share1
            rest, unit = (1 << TOTAL_BITS) - both, span[:m] >> UNIT
            value = (code[:m] // unit).astype(np.int64)
            # Both sides of the quotient are below 2 to the 40, so rounding it to a double takes it over no integer.
            inner = np.maximum(value - both, 0)
            inner += 1
            inner <<= ZERO_BITS
            inner -= 1
            inner = (inner / rest).astype(np.int64)
            inner += group.lane_zero[:m]
            now = symbol[t, :m]
            now[:] = found.take(inner, mode="clip")  # beyond its block only in a damaged one
            at = group.lane_sums[:m] + now
            below = rest * sums.take(at) >> ZERO_BITS
            at += 1
            width = (rest * sums.take(at) >> ZERO_BITS) - below
            below += both
            np.greater(share1, 0, out=given1[t, :m])
            named, by2 = value < both, value < share2
            np.copyto(now, np.where(by2, named2, named1), where=named)
            np.copyto(below, np.where(by2, 0, share2), where=named)
            np.copyto(width, np.where(by2, share2, share1), where=named)
            code[:m] -= unit * below.astype(np.uint64)
            np.multiply(unit, width.astype(np.uint64), out=span[:m])
            short = span[:m] < ONE_DIGIT
            shift = short * DIGIT
            code[:m] <<= shift
            code[:m] |= digits.take(ahead[:m], mode="clip") * short
            ahead[:m] += short
            span[:m] <<= shift
            older, last = last, now
        n = stop - first
        symbols[first:stop] = symbol[:n]
        older, last = older.copy(), last.copy()
        if stop < places:
            group.learn(stop, renewed, symbols[first:stop], place2[:n], place1[:n], entry2[:n], entry1[:n], given1[:n])
    out = [np.empty(n, np.uint32) for n in sizes]
    symbols = np.ascontiguousarray(symbols.T)
    for lane, (b, first, length) in enumerate(zip(group.block.tolist(), group.first.tolist(), group.length.tolist(), strict=True)):
        out[b][first:first + length] = parted[b][0][symbols[lane, :length]]
    return out
