"""Best-fit packing of token pieces into sequences of bounded length.

A document's ids, with an end id, are cut into pieces of the sequence length; the first piece takes the
rest. Whole pieces are sequences of their own. All others are packed online: the smallest free space
that fits takes the next piece. A fixed number of bins is open, found through a bitset keyed by free
space; when there is one more, the fullest is closed. Pieces are dealt evenly into lanes of bounded
size, each packed by one task that holds the open bins only. In a lane they arrive in blocks dealt by a hash, in
a block longest first, so that short ones fill what long ones left open, in this block or one before. There are fewer
open bins than a block has long pieces: the bound closes the fullest, which hardly any piece would still fit.

Defined cases: a null or empty text is its end id alone. Copies and repeated rows are packed each.
An empty table gives no pieces. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.text import Texts
from alertloom.llm.tokens import crc32_of, tokenizer, vocabulary_path
from alertloom.session import stored

CAPACITY = 1024
END = 2
OPEN = 512
BLOCK = 1250
LANE = 20_000


class BestFit:
    """Online best-fit with a bounded number of open bins."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        # Bit f of `spaces` is set if an open bin has f free; `bins[f]` lists these bins.
        self.spaces = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        # `closed` counts the bins that the bound closed.
        self.open = self.made = self.closed = 0

    def place(self, size: int) -> tuple[int, int]:
        """The bin and the offset in it for the next piece."""
        fitting = self.spaces >> size
        if fitting:
            free = size + ((fitting & -fitting).bit_length() - 1)
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            self.bins[left].append(number)
            self.spaces |= 1 << left
            self.open += 1
            if self.open > self.most_open:
                self.closed += 1
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.spaces &= ~(1 << free)
        self.open -= 1
        return number


def pack_sizes(sizes: Iterable[int], capacity: int = CAPACITY, most_open: int = OPEN) -> Iterator[tuple[int, int]]:
    """(bin, offset) for each size in turn."""
    fit = BestFit(capacity, most_open)
    for size in sizes:
        yield fit.place(size)


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """The documents' pieces, numbered in `seat` within each task; `ids` adds the token ids themselves."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "seat"]
    source = docs.select("doc_id", "text")
    kinds = [source.schema["doc_id"].dataType, T.IntegerType(), *[T.LongType()] * 5]
    fields = [T.StructField(n, k) for n, k in zip(names, kinds)]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        task, seat = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = Texts.of(batch.column(1))
            for low, high, part in texts.slices(4 << 20):
                flat, at = tokenizer(path).encode(part, end)
                rows: list[tuple] = []
                for i in range(high - low):
                    rows += [(low + i, p, s, n, at[i]) for p, (s, n) in enumerate(cut(int(at[i + 1] - at[i]), capacity))]
                doc, number, start, length, base = (np.array(x) for x in zip(*rows))
                spans = list(zip((base + start).tolist(), (base + start + length).tolist()))
                columns = [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([crc32_of(flat[a:b]) for a, b in spans], pa.int64()),
                    pa.array(np.full(len(rows), task), pa.int64()),
                    pa.array(np.arange(seat, seat + len(rows)), pa.int64()),
                ]
                if ids:
                    bounds = np.append(base + start, len(flat)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32))))
                seat += len(rows)
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def arrivals(short: DataFrame, n: int, lane: int = LANE, block: int = BLOCK) -> DataFrame:
    """task, seat, length, lane and block of the `n` pieces to be packed, and `mixed`, a hash of their place in the table.

    The hash deals them into blocks, whatever the documents' ids; neighbouring blocks make up a lane.
    """
    blocks, in_lane = max(1, -(-n // block)), max(1, lane // block)
    mixed = F.xxhash64("task", "seat")
    number = F.pmod(mixed, F.lit(blocks))
    return short.select(
        "task", "seat", "length", mixed.alias("mixed"), F.floor(number / in_lane).alias("lane"), number.alias("block")
    )


def pack_pieces(
    cut_up: DataFrame, capacity: int = CAPACITY, most_open: int = OPEN, lane: int = LANE, block: int = BLOCK
) -> DataFrame:
    """`cut_up` (a stored table with length, task and seat) with sequence_id and offset.

    Whole pieces stay where they are. The others are packed lane by lane; a task takes many lanes of a large table.
    """
    short = cut_up.where(F.col("length") < capacity)
    n = short.count()
    dealt = arrivals(short, n, lane, block)

    def run(batches):
        fits: dict[int, BestFit] = {}
        for batch in batches:
            out = []
            for number, size in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist()):
                if number not in fits:
                    # Rows come lane by lane: the bins of the lane before are done with.
                    fits.clear()
                    fits[number] = BestFit(capacity, most_open)
                made, offset = fits[number].place(size)
                out.append((number << 32 | made, offset))
            sequence, offset = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["task", "seat", "sequence_id", "offset"],
            )

    tasks = min(max(1, -(-n // lane)), 4 * short.sparkSession.sparkContext.defaultParallelism)
    order = ("lane", "block", F.desc("length"), "mixed", "task", "seat")
    ordered = dealt.repartition(tasks, "lane").sortWithinPartitions(*order)
    placed = ordered.select("task", "seat", "length", "lane").mapInArrow(
        run, "task long, seat long, sequence_id long, offset long"
    )
    # Whole pieces take negative numbers, by their place.
    own = -(F.shiftleft(F.col("task"), 40) + F.col("seat") + 1)
    full = cut_up.where(F.col("length") >= capacity).withColumns({"sequence_id": own, "offset": F.lit(0).cast("long")})
    packed = short.join(placed, ["task", "seat"])
    return packed.unionByName(full).drop("task", "seat")


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, ids: bool = False
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack_pieces(stored(pieces(docs, path or vocabulary_path(), capacity, end, ids)), capacity)
