"""Token ids of whole Arrow batches with a byte-level BPE vocabulary.

The `tokenizers` library encodes; its cost is almost all per piece of text between its split points. Texts in
common letters are therefore split here with numpy, for a slice of many texts at once, and every
distinct piece is encoded once by the library. Texts with other characters, or with the vocabulary's
special token, go to the library whole. Ids are equal either way (tested).
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from operator import attrgetter

import numpy as np
import public_tokenizers
import regex

from alertloom.llm.text import Texts, mix

VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
# Characters up to here have a class; texts with others are not split here.
_KNOWN = 0x250
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# New pieces beyond this number start the cache anew, which bounds its memory at about 150 MB.
_MOST_CACHED = 3_000_000
# Pieces with more characters are known by Python's hash.
_LONGEST = 1 << 12
_ODD = 0x9E3779B97F4A7C15
_S32, _M32 = np.uint64(32), np.uint64(2**32 - 1)
_SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")


def _byte_letters() -> list[str]:
    """The letters that the vocabulary has for bytes: visible ones for themselves, then those from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


def _classes() -> np.ndarray:
    table = np.full(_KNOWN, _OTHER, np.uint8)
    for c in range(_KNOWN):
        for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
            if regex.fullmatch(pattern, chr(c)):
                table[c] = kind
    return table


_CLASS = _classes()
with np.errstate(over="ignore"):
    _VALUE = mix(np.arange(1, _KNOWN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _POWER = np.cumprod(np.full(1 << 16, _ODD, np.uint64), dtype=np.uint64)
    _INVERSE = np.cumprod(np.full(1 << 16, pow(_ODD, -1, 1 << 64), np.uint64), dtype=np.uint64)


class Tokenizer:
    """Encodes texts. `path` names the vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self._library = Library.from_file(path)
        self._model = self._library.model
        self._clear()

    def _clear(self) -> None:
        # A table by hash of the pieces' hashes and spans of ids; hash 0 is a free place.
        self._table = np.zeros((1 << 16, 2), np.uint64)
        self._kept = 0
        self._flat = np.zeros(1 << 16, np.uint16)
        self._size = 0

    def encode(self, texts: Texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by `end`, as uint32, and the offsets of the texts."""
        flat, lengths = [], []
        for _, _, part in texts.slices(1 << 20):
            ids, counts = self._encode(part, end)
            flat.append(ids)
            lengths.append(counts)
        counts = np.concatenate([np.zeros(1, np.int64), *lengths])
        return np.concatenate([np.zeros(0, np.uint32), *flat]), np.cumsum(counts)

    def _encode(self, texts: Texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        raw = [texts.raw(i).decode() for i in range(len(texts))]
        joined = "".join(raw)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if self._is_plain(joined, code):
            ids, at = self._encode_plain(raw, joined, code)
            out = np.full(len(ids) + len(raw), end, np.uint32)
            own = np.ones(len(out), bool)
            own[at[1:] + np.arange(len(raw))] = False
            out[own] = ids
            return out, np.diff(at) + 1
        plain = [self._is_plain(t, np.frombuffer(t.encode("utf-32-le"), np.uint32)) for t in raw]
        chosen = [t for t, p in zip(raw, plain) if p]
        joined = "".join(chosen)
        ids, at = self._encode_plain(chosen, joined, np.frombuffer(joined.encode("utf-32-le"), np.uint32))
        pieces, counts, j = [], np.zeros(len(raw), np.int64), 0
        tail = np.array([end], np.uint32)
        for i, (t, p) in enumerate(zip(raw, plain)):
            if p:
                mine = ids[at[j] : at[j + 1]]
                j += 1
            else:
                mine = np.array(self._library.encode(t, add_special_tokens=False).ids, np.uint32)
            pieces += [mine, tail]
            counts[i] = len(mine) + 1
        return np.concatenate([np.zeros(0, np.uint32), *pieces]), counts

    @staticmethod
    def _is_plain(text: str, code: np.ndarray) -> bool:
        return "<|" not in text and not (code >= _KNOWN).any()

    def _encode_plain(self, texts: list[str], joined: str, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        firsts = np.concatenate([np.zeros(1, np.int64), ends])
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = split(code, firsts)
        spans = self._look_up(code, starts, joined)
        low = (spans >> _S32).view(np.int64)
        lengths = (spans & _M32).view(np.int64)
        total = np.zeros(len(spans) + 1, np.int64)
        np.cumsum(lengths, out=total[1:])
        low -= total[:-1]
        take = np.repeat(low, lengths)
        take += np.arange(len(take))
        return self._flat.take(take).astype(np.uint32), total[np.searchsorted(starts, firsts)]

    def _look_up(self, code: np.ndarray, starts: np.ndarray, joined: str) -> np.ndarray:
        """Where the ids of each piece begin (high half), and how many; new pieces are encoded first."""
        ends = np.append(starts[1:], len(code))
        lengths = ends - starts
        keys = _hashes(code, starts)
        for i in np.flatnonzero(lengths > _LONGEST):
            keys[i] = np.uint64(hash(joined[starts[i] : ends[i]]) & (2**64 - 1))
        keys[keys == 0] = 1
        spans, new = self._find(keys)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            if self._kept + len(distinct) > _MOST_CACHED:
                self._clear()
                new = np.arange(len(keys))
                distinct, first = np.unique(keys, return_index=True)
            at = new[first]
            added = self._add([joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            self._keep(distinct, added)
            spans[new] = self._find(keys[new])[0]
        return spans

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans of the keys, and which keys are not in the table."""
        last = np.intp(len(self._table) - 1)
        place = keys.astype(np.intp) & last
        rows = self._table.take(place, axis=0)
        spans = rows[:, 1].copy()
        new = []
        other = np.flatnonzero(rows[:, 0] != keys)
        found = rows[other, 0]
        while len(other):
            free = found == 0
            new.append(other[free])
            other = other[~free]
            place[other] = (place[other] + 1) & last
            rows = self._table.take(place[other], axis=0)
            spans[other] = rows[:, 1]
            unlike = rows[:, 0] != keys[other]
            other, found = other[unlike], rows[unlike, 0]
        return spans, np.concatenate([np.zeros(0, np.intp), *new])

    def _keep(self, keys: np.ndarray, spans: np.ndarray) -> None:
        """Put new keys into the table, which is at most three quarters full."""
        self._kept += len(keys)
        size = len(self._table)
        while 4 * self._kept > 3 * size:
            size *= 2
        if size > len(self._table):
            old = self._table[self._table[:, 0] != 0]
            keys, spans = np.concatenate([old[:, 0], keys]), np.concatenate([old[:, 1], spans])
            self._table = np.zeros((size, 2), np.uint64)
        place = keys.astype(np.intp) & np.intp(size - 1)
        while len(keys):
            free = np.flatnonzero(self._table[place, 0] == 0)
            # Of keys for the same place one gets it; the others go on.
            self._table[place[free], 0] = keys[free]
            got = free[self._table[place[free], 0] == keys[free]]
            self._table[place[got], 1] = spans[got]
            rest = np.ones(len(keys), bool)
            rest[got] = False
            keys, spans, place = keys[rest], spans[rest], (place[rest] + 1) & np.intp(size - 1)

    def _add(self, words: list[str]) -> np.ndarray:
        """Encode new pieces; the spans of their ids."""
        # The library would find a run of letters whole again; its model encodes it without the search.
        tokenize, number, space = self._model.tokenize, attrgetter("id"), _BYTE_LETTERS[0x20]
        runs = [(w[1:] if w[0] == " " else w).isalpha() for w in words]
        others = [w for w, is_run in zip(words, runs) if not is_run]
        found = []
        for low in range(0, len(others), 4096):
            found += self._library.encode_batch_fast(others[low : low + 4096], add_special_tokens=False)
        rest = iter(found)
        ids: list[int] = []
        ends = []
        for word, is_run in zip(words, runs):
            if not is_run:
                ids += next(rest).ids
            elif word.isascii():
                ids += map(number, tokenize(space + word[1:] if word[0] == " " else word))
            else:
                ids += map(number, tokenize("".join([_BYTE_LETTERS[b] for b in word.encode()])))
            ends.append(len(ids))
        flat = np.array(ids, np.uint16)
        lengths = np.diff(np.array(ends), prepend=0)
        while self._size + len(flat) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        self._flat[self._size : self._size + len(flat)] = flat
        firsts = self._size + np.cumsum(lengths) - lengths
        self._size += len(flat)
        return (firsts.astype(np.uint64) << _S32) | lengths.astype(np.uint64)


def _hashes(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the pieces; those of pieces above the longest mean nothing."""
    out = np.zeros(len(starts), np.uint64)
    bounds = np.append(starts, len(code))
    low = 0
    with np.errstate(over="ignore"):
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + len(_POWER), side="right")) - 1)
            first, end = bounds[low], bounds[high]
            if end - first <= len(_POWER):
                at = starts[low:high] - first
                parts = _VALUE.take(code[first:end])
                parts *= _POWER[: end - first]
                out[low:high] = np.add.reduceat(parts, at) * _INVERSE.take(at)
            low = high
        return mix(out + np.diff(bounds).astype(np.uint64))


def split(code: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pieces of the vocabulary's split pattern start, in texts joined one after the other.

    A piece is a run of letters, of numbers or of other marks, with one space before it; a run of white space
    up to its last character if more follows; or an apostrophe ending. `firsts` has the texts' offsets.
    """
    n = len(code)
    kind = _CLASS[code]
    begins = np.zeros(n + 1, bool)
    begins[firsts] = True
    fresh = begins[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    # The last white space before something else stands alone, or joins what follows if it is a space.
    last = np.zeros(n, bool)
    last[:-1] = (kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~begins[1:n]
    starts = fresh.copy()
    starts[last] = True
    joins = np.flatnonzero(last & (code == 0x20)) + 1
    starts[joins] = False
    # Apostrophe endings: only where the apostrophe starts a piece, before letters.
    quote = np.flatnonzero((code[:-1] == 0x27) & starts[:-1] & (kind[1:] == _LETTER) & ~begins[1:n])
    if len(quote):
        second = code[quote + 1]
        third = np.where(quote + 2 < n, code[np.minimum(quote + 2, n - 1)], 0)
        third = np.where(begins[np.minimum(quote + 2, n)], 0, third)
        length = np.zeros(len(quote), np.int64)
        for s in _SUFFIXES:
            same = second == ord(s[0])
            if len(s) == 2:
                same &= third == ord(s[1])
            length[same & (length == 0)] = len(s)
        hit = length > 0
        at, size = quote[hit], length[hit]
        starts[at + 1] = False
        after = at + 1 + size
        inside = after[after < n]
        starts[inside] = True
    return np.flatnonzero(starts)


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def crc32_of(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


@lru_cache(maxsize=1)
def tokenizer(path: str) -> Tokenizer:
    """The process's tokenizer, which keeps its pieces from task to task."""
    return Tokenizer(path)
