"""A context-mixing range coder for token ids, working on many lanes at once.

A block of ids is cut into lanes, each a stretch of the block with a range coder of its own. All lanes take
a step together as numpy vectors and share one adaptive model, which starts anew in every block.

Three distributions are mixed for each id: the frequencies of the ids that followed the two ids before
(order 2), of those that followed the id before (order 1), and of all ids so far (order 0). A context of order 1
or 2 keeps the ids most frequent in it, eight and four; contexts share a place if their hashes are equal. The
distributions are added with weights, learnt for each combination of how much the contexts have seen, by
what each distribution contributed to the ids that came. The coder narrows its range to the id's share of the
sum. All arithmetic is on whole numbers, so a block decodes alike everywhere. Orders 1 and 2 count every step's ids
at once, order 0 after more and more steps; the weights learn from each of the first steps, then from some.

The words that lanes settle are stored in the order in which the decoder takes them, so that it reads them as one
stream for all lanes.

A block has its own header and ends with a checksum of all before it and of its ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 4096
STEPS = 256
_HEADER = struct.Struct("<4sBIIII")
_MAGIC = b"TIDC"
# Ids below this are their own symbols; a block with larger ones lists its ids.
_DIRECT = 1 << 17

_TOTAL_BITS = 30
_TOTAL = 1 << _TOTAL_BITS
_LEAST0, _LEAST = 1 << 23, 1 << 20
_STATES = 6
# Steps after which the weights learn: each of the first ones, later every sixteenth.
_EAGER, _EVERY = 16, 16
# Hash bits and ids kept of contexts of order 1 and 2, and the sum of frequencies at which these are halved.
_BITS, _KEPT, _FULL = (16, 18), (8, 4), 240
# An entry of a context is an id and, in the lowest bits, its frequency.
_ID, _COUNT = 8, 0xFF
# Frequencies of order 0 that add up to at most 2**22 have a table of the symbol at each place.
_PLACES = 22

_ST, _S31, _S32 = np.uint64(_TOTAL_BITS), np.uint64(31), np.uint64(32)
_M31, _M32 = np.uint64((1 << 31) - 1), np.uint64((1 << 32) - 1)
_W31 = np.uint64(1 << 31)


def _states() -> np.ndarray:
    """The state of a context by its sum of frequencies (high byte) and the highest one."""
    total, most = np.divmod(np.arange(1 << 16), 1 << 8)
    # Nothing, one id once, one id a few times and often, several ids with and without a frequent one.
    one = np.where(total < 2, total, np.where(total < 4, 2, 3))
    return np.where(most == total, one, np.where(2 * most < total, 4, 5)).astype(np.uint16)


_STATE = _states()


class _Context:
    """The frequencies of the ids that followed each context of one order.

    `entries`, `ids` and `seen` are this order's part of the model's arrays, one column for each lane.
    """

    def __init__(self, bits: int, kept: int, entries: np.ndarray, ids: np.ndarray, seen: np.ndarray):
        self.kept, self.entries, self.ids, self.seen = kept, entries, ids, seen
        # Entries without an id have the highest one and no frequency.
        self.table = np.full((1 << bits, kept), np.iinfo(entries.dtype).max ^ _COUNT, entries.dtype)
        self.flat = self.table.reshape(-1)

    def look(self, at: np.ndarray) -> None:
        """Take the rows of all lanes."""
        self.at = at
        np.copyto(self.entries, self.table.take(at, axis=0).T)

    def sum(self) -> None:
        # The sum stays below 256: a step adds at most one to each entry.
        self.total = np.add.reduce(self.seen, axis=0, dtype=np.uint8)
        row = self.total.astype(np.uint16)
        row <<= np.uint16(8)
        row |= np.maximum.reduce(self.seen, axis=0)
        self.state = _STATE.take(row)

    def update(self, place: np.ndarray, entry: np.ndarray) -> None:
        # Of lanes at the same place, the last one's change holds.
        spot = self.at * self.kept
        spot += place
        self.flat[spot] = entry
        full = np.flatnonzero(self.total >= _FULL)
        if len(full):
            rows = self.table[self.at[full]]
            self.table[self.at[full]] = rows - ((rows & rows.dtype.type(_COUNT)) >> rows.dtype.type(1))


class _Model:
    """The mixed distribution of all lanes, its weights, and the frequencies of all symbols."""

    def __init__(self, lanes: int, symbols: int):
        self.symbols = symbols
        kind = np.uint32 if symbols < 1 << (32 - _ID) else np.int64
        self.shift = kind(_ID)
        rows = sum(_KEPT)
        self.entries = np.empty((rows, lanes), kind)
        self.ids = np.empty((rows, lanes), np.uint16 if symbols < 1 << 16 else kind)
        self.seen = np.empty((rows, lanes), np.uint8)
        parts = slice(0, _KEPT[0]), slice(_KEPT[0], rows)
        self.contexts = [_Context(b, k, self.entries[p], self.ids[p], self.seen[p]) for b, k, p in zip(_BITS, _KEPT, parts)]
        # For the least frequent entry of a context: frequencies up to the mean of a full one, and its places.
        kept = np.repeat(_KEPT, _KEPT)[:, None]
        self.step_of, self.place_of = kept.astype(np.uint8), np.concatenate([np.arange(k) for k in _KEPT])[:, None].astype(np.uint8)
        self.most_of = (256 // kept - 2).astype(np.uint8)
        # Frequencies of order 0 add up to a power of two; every symbol has one at least.
        self.bits = max(12, min(symbols.bit_length() + 4, _PLACES), symbols.bit_length() + 1)
        self.total = 1 << self.bits
        self.raw = np.zeros(symbols, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_counted = self.step = 0
        self.last1, self.last2 = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        # Every symbol keeps a share: order 0 has at least as many parts as the sum of frequencies.
        self.least0 = max(_LEAST0, self.total)
        # What each order contributed to the ids that came, by class.
        self.gained = np.full((_STATES * _STATES, 3), 1 << 16, np.int64)
        self._weigh()
        self._sum()

    def _sum(self) -> None:
        """Count the ids that wait, and take the frequencies of all so far into use."""
        if self.waiting:
            self.raw += np.bincount(np.concatenate(self.waiting), minlength=self.symbols)
            self.n_counted += self.n_waiting
            self.waiting, self.n_waiting = [], 0
        spare = self.total - self.symbols
        self.counts = 1 + (self.raw * ((spare << 20) // max(self.n_counted, 1)) >> 20)
        self.below = np.zeros(self.symbols + 1, np.int64)
        np.cumsum(self.counts, out=self.below[1:])
        # What rounding leaves over goes to the last symbol.
        self.counts[-1] += self.total - self.below[-1]
        self.below[-1] = self.total
        self.places = None

    def _weigh(self) -> None:
        """What one count of order 1 and 2 is worth, by class and sum of counts; order 0 has the rest."""
        spare = _TOTAL - self.least0 - 2 * _LEAST
        shares = (self.gained[:, 1:] << 12) // self.gained.sum(axis=1, keepdims=True)
        weights = ((shares * spare) >> 12) + _LEAST
        totals = np.maximum(np.arange(1 << 8), 1)
        self.worth = [(weights[:, k, None] // totals).reshape(-1) for k in range(len(_KEPT))]

    def predict(self) -> None:
        first, second = self.contexts
        h = self.last1 * np.uint32(0x9E3779B1)
        first.look((h >> np.uint32(32 - _BITS[0])).astype(np.intp))
        h = (h ^ (h >> np.uint32(15)) ^ (self.last2 * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
        second.look((h >> np.uint32(32 - _BITS[1])).astype(np.intp))
        np.copyto(self.seen, self.entries, casting="unsafe")
        self.entries >>= self.shift
        np.copyto(self.ids, self.entries, casting="unsafe")
        first.sum()
        second.sum()
        self.kind = first.state * np.uint16(_STATES) + second.state
        # The parts that one count is worth; what an empty context leaves goes to order 0.
        row = self.kind << np.uint16(8)
        self.units = [w.take(row | c.total) for w, c in zip(self.worth, self.contexts)]
        self.rest = _TOTAL - self.units[0] * first.total - self.units[1] * second.total

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        """The sums of both orders' rows."""
        k = _KEPT[0]
        return [np.add.reduce(part, axis=0, dtype=np.uint8) for part in (rows[:k], rows[k:])]

    def share(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids' share of the mixed total begins, and its size."""
        start = self.below.take(ids)
        start *= self.rest
        start >>= self.bits
        part = self.below[1:].take(ids)
        part *= self.rest
        part >>= self.bits
        part -= start
        same = ids.astype(self.ids.dtype)
        self.hit = (self.ids == same).view(np.uint8)
        below = (self.ids < same).view(np.uint8)
        below *= self.seen
        self.own = self._split(self.hit * self.seen)
        self.parts, self.whole = [part], part.copy()
        for unit, before, own in zip(self.units, self._split(below), self.own):
            start += unit * before
            part = unit * own
            self.parts.append(part)
            self.whole += part
        return start.view(np.uint64), self.whole.view(np.uint64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids in whose shares the values lie."""
        if self.places is None and self.bits <= _PLACES:
            self.places = np.repeat(np.arange(self.symbols, dtype=self.ids.dtype), self.counts)
        # For each id that a context knows, the counts of smaller ids in both contexts.
        before = np.zeros((len(_KEPT), *self.seen.shape), np.uint8)
        smaller = np.empty(self.seen.shape, bool)
        ones = smaller.view(np.uint8)
        for sums, context in zip(before, self.contexts):
            for one, seen in zip(context.ids, context.seen):
                np.greater(self.ids, one, out=smaller)
                ones *= seen
                sums += ones
        # Below such an id lie its share by order 0 and the contexts' shares of smaller ids.
        at = self.below.take(self.ids, mode="clip")
        at *= self.rest
        at >>= self.bits
        at = at.astype(np.uint32)
        for unit, sums in zip(self.units, before):
            mass = sums.astype(np.uint32)
            mass *= unit.astype(np.uint32)
            at += mass
        upto = (at <= value.astype(np.uint32)).view(np.uint8)
        least = np.maximum.reduce(self.ids * upto, axis=0)
        upto *= self.seen
        left = value.copy()
        for unit, own in zip(self.units, self._split(upto)):
            left -= unit * own
        # Where the value lies in a context's share of an id, order 0 finds a smaller id or the same.
        np.maximum(left, 0, out=left)
        left += 1
        left <<= self.bits
        left -= 1
        left //= self.rest
        ids = np.searchsorted(self.below, left, side="right") - 1 if self.places is None else self.places.take(left)
        return np.maximum(ids, least).astype(np.uint32)

    def update(self, ids: np.ndarray) -> None:
        self.step += 1
        if self.step <= _EAGER or self.step % _EVERY == 0:
            for k, part in enumerate(self.parts):
                self.gained[:, k] += np.bincount(self.kind, (part << 12) // self.whole, len(self.gained)).astype(np.int64)
            self.gained -= self.gained >> 5
            np.maximum(self.gained, 1, out=self.gained)
            self._weigh()
        # The place of the id, else of the lowest frequency: places differ in the lowest bits.
        order = np.minimum(self.seen, self.most_of)
        order += np.uint8(1)
        order *= self.step_of
        order *= self.hit ^ np.uint8(1)
        order |= self.place_of
        k = 0
        shifted = ids.astype(self.entries.dtype) << self.shift
        for context, own in zip(self.contexts, self.own):
            place = np.minimum.reduce(order[k : k + context.kept], axis=0) & np.uint8(context.kept - 1)
            context.update(place, shifted | (own + np.uint8(1)))
            k += context.kept
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= min(self.n_counted >> 1, self.total >> 2):
            self._sum()
        self.last2, self.last1 = self.last1, ids


def _shape(n: int, lanes: int, steps: int) -> tuple[int, int]:
    lanes = int(np.clip(n // steps, 1, lanes))
    return lanes, -(-n // lanes)


def _turned(rows: np.ndarray) -> np.ndarray:
    """Columns as rows, a few at a time."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    short = rows if len(rows) <= rows.shape[1] else out
    for k in range(0, len(short), 16):
        if short is rows:
            out[:, k : k + 16] = rows[k : k + 16].T
        else:
            out[k : k + 16] = rows[:, k : k + 16].T
    return out


def encode_block(ids: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """The ids, unsigned and below 2**32, as one independent block."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    listed, symbols = np.zeros(0, np.uint32), ids
    if n and int(ids.max()) >= _DIRECT:
        listed, symbols = np.unique(ids, return_inverse=True)
    size = len(listed) or (int(ids.max()) + 1 if n else 0)
    lanes, steps = _shape(n, lanes, steps) if n else (0, 0)
    words = _encode(symbols.astype(np.uint32), size, lanes, steps) if n else b""
    body = _HEADER.pack(_MAGIC, len(listed) > 0, n, lanes, steps, size) + listed.astype("<u4").tobytes() + words
    return body + struct.pack("<II", zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes()))


def _encode(ids: np.ndarray, symbols: int, lanes: int, steps: int) -> bytes:
    full = np.zeros(lanes * steps, np.uint32)
    full[: len(ids)] = ids
    columns = _turned(full.reshape(lanes, steps))
    model = _Model(lanes, symbols)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, _W31 << _S31, np.uint64)
    where: list[np.ndarray] = []
    what: list[np.ndarray] = []
    for now in columns:
        model.predict()
        start, size = model.share(now)
        width >>= _ST
        low += width * start
        width *= size
        out = np.flatnonzero(width < _W31)
        settled = low[out]
        where.append(out)
        what.append(settled >> _S31)
        low[out] = (settled & _M31) << _S32
        width[out] <<= _S32
        model.update(now)
    # The highest 33 bits, one more, tell a number in the range; the decoder reads zeros after them.
    every = np.arange(lanes)
    where += [every, every]
    what += [(low + _M31) >> _S31, np.zeros(lanes, np.uint64)]
    lane = np.concatenate(where).astype(np.uint32 if lanes > 1 << 16 else np.uint16)
    order = np.argsort(lane, kind="stable")
    words = np.concatenate(what)[order]
    # A word has 33 bits; the highest is carried to the word before it in its lane.
    while len(over := np.flatnonzero(words > _M32)):
        words[over] &= _M32
        words[over - 1] += np.uint64(1)
    # The first word of a lane gets a zero bit in front, which moves all others on by one bit.
    counts = np.bincount(lane, minlength=lanes)
    firsts = np.cumsum(counts) - counts
    before = np.concatenate([np.zeros(1, np.uint64), words[:-1]])
    before[firsts] = 0
    words = ((before << _S31) & _M32) | (words >> np.uint64(1))
    # The decoder starts with two words of each lane; after each word that was settled here it takes one more.
    n = len(order) - 2 * lanes
    taken = np.empty(len(order), np.int64)
    taken[order] = np.arange(len(order)) + 2
    stream = np.concatenate([words[firsts], words[firsts + 1], words[taken[:n]]])
    return stream.astype("<u4").tobytes()


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; an error if the block is damaged."""
    if len(block) < _HEADER.size + 8 or block[:4] != _MAGIC:
        raise ValueError("not a block of token ids")
    body, (whole, check) = block[:-8], struct.unpack("<II", block[-8:])
    if zlib.crc32(body) != whole:
        raise ValueError("the checksum of a block does not hold")
    _, is_listed, n, lanes, steps, symbols = _HEADER.unpack_from(body)
    at = _HEADER.size
    listed = np.frombuffer(body, "<u4", symbols if is_listed else 0, at)
    ids = _decode(body[at + 4 * len(listed) :], symbols, n, lanes, steps) if n else np.zeros(0, np.uint32)
    if is_listed:
        ids = listed.astype(np.uint32)[ids]
    if zlib.crc32(ids.astype("<u4").tobytes()) != check:
        raise ValueError("the checksum of a block's ids does not hold")
    return ids


def _decode(data: bytes, symbols: int, n: int, lanes: int, steps: int) -> np.ndarray:
    words = np.frombuffer(data, "<u4").astype(np.uint64)
    code = (words[:lanes] << _S32) | words[lanes : 2 * lanes]
    at = 2 * lanes
    model = _Model(lanes, symbols)
    width = np.full(lanes, _W31 << _S31, np.uint64)
    out = np.zeros((steps, lanes), np.uint32)
    most = np.uint64(_TOTAL - 1)
    for t in range(steps):
        model.predict()
        width >>= _ST
        ids = model.find(np.minimum(code // width, most).view(np.int64))
        start, size = model.share(ids)
        code -= width * start
        width *= size
        read = np.flatnonzero(width < _W31)
        width[read] <<= _S32
        code[read] = (code[read] << _S32) | words[at : at + len(read)]
        at += len(read)
        out[t] = ids
        model.update(ids)
    return _turned(out).reshape(-1)[:n]
