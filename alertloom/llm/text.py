"""Words, shingles and their hashes for whole Arrow batches of texts.

A batch of texts is one byte buffer with offsets. Words are found and hashed with numpy over that
buffer, a few megabytes at a time, so no Python object is made per word. Hashes are 64 bits wide:
each byte picks a random 64-bit number, multiplied by an odd power for its place in the word, and
the sum is mixed. Equal words have equal hashes in every process and run.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 19
_LONGEST = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _numbers(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(steps + np.uint64(seed))


_BYTE = _numbers(256, 11)
_PLACE = _numbers(_LONGEST, 23) | np.uint64(1)
_ORDER = _numbers(64, 37) | np.uint64(1)


def byte_set(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags, set for the bytes of the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_set([(0x20, 0x20), (0x09, 0x0D)])
NOT_ALNUM = byte_set([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Texts:
    """Some texts as UTF-8 bytes with their offsets; null texts are empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = column.cast(pa.large_string()).fill_null("")
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(data[at[0] : at[-1]], at - at[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flags, one for each byte, are set in each text."""
        at = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return at[self.offsets[1:]] - at[self.offsets[:-1]]

    def slices(self, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
        """Consecutive runs of texts of up to `limit` bytes; a longer text is a run of its own."""
        i = 0
        while i < len(self):
            j = int(np.searchsorted(self.offsets, self.offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), len(self))
            low, high = self.offsets[i], self.offsets[j]
            yield i, j, Texts(self.data[low:high], self.offsets[i : j + 1] - low)
            i = j


class Words:
    """The words of some texts: maximal runs of bytes that are not in `delimiters`.

    `first[i]:first[i + 1]` are the words of text i, `starts` and `ends` their byte places.
    """

    def __init__(self, texts: Texts, delimiters: np.ndarray, lower: bool = False):
        self.texts = texts
        data = _LOWER[texts.data] if lower else texts.data
        self.inside = ~delimiters[data]
        inside = self.inside
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = texts.offsets[:-1]
        at = at[at < len(inside)]
        begins[at] = inside[at]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = texts.offsets[1:-1]
        ends = ends[ends > 0] - 1
        last[ends] = inside[ends]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, texts.offsets)
        self.hashes = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        with np.errstate(over="ignore"):
            within = np.flatnonzero(self.inside)
            firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            place = np.arange(len(within)) - np.repeat(firsts, lengths)
            parts = _BYTE[data[within]]
            parts *= _PLACE[place if lengths.max() <= _LONGEST else place % _LONGEST]
            out = np.add.reduceat(parts, firsts) + lengths.astype(np.uint64)
        for i in np.flatnonzero(lengths > _LONGEST):
            out[i] = xxhash.xxh3_64_intdigest(data[self.starts[i] : self.ends[i]].tobytes())
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k words from each word on; only meaningful where k words follow."""
        h = self.hashes
        out = np.zeros(max(0, len(h) - k + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                out += h[j : j + len(out)] * _ORDER[j]
        return mix(out)

    def whole(self, i: int) -> np.uint64:
        """The hash of all words of text i as one sequence; equals `grams(k)` if there are k."""
        return sequence_hash(self.hashes[self.first[i] : self.first[i + 1]])


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        total = (hashes * _ORDER[: len(hashes)]).sum(dtype=np.uint64)
    return mix(np.array([total], np.uint64))[0]


def release() -> None:
    """Give freed memory back to the system at the end of a task: the Python worker lives on."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def append_columns(df: DataFrame, fields: T.StructType, compute, prefix: str = "") -> DataFrame:
    """Pass every row on with more columns, computed for whole Arrow batches.

    `compute(batch)` returns an array or list for each field. Fields whose names are taken already
    must be renamed by `prefix`. Columns of the input may have any names and types.
    """
    names = [prefix + f.name for f in fields]
    clash = {n.lower() for n in names} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already; give a prefix")
    kinds = [_arrow(f.dataType) for f in fields]
    given = df.columns
    # Spark's call takes columns by name, which fails for names with dots.
    plain = df.toDF(*[f"c{i}" for i in range(len(given))])
    more = [T.StructField(f"m{i}", f.dataType) for i, f in enumerate(fields)]
    schema = T.StructType([*plain.schema.fields, *more])

    def run(batches):
        for batch in batches:
            made = compute(pa.RecordBatch.from_arrays(batch.columns, names=given))
            arrays = [pa.array(x, type=k, from_pandas=False) for x, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=schema.names)
        release()

    return plain.mapInArrow(run, schema).toDF(*given, *names)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def free_prefix(df: DataFrame, stem: str = "x") -> str:
    """A prefix that no column of `df` starts with."""
    prefix = f"{stem}_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of `df`, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
