"""Token ids of documents in compressed files of independent blocks.

Documents are put in ascending order of doc_id, tokenised, and written as blocks of whole documents
(`codec`): order-0 to order-2 predictions of the ids drive an arithmetic coder that starts anew in each
block. A file is Parquet with one block per row: its place (part, block), the table of its documents,
their number of ids, and the coded ids with their checksum. Any block can be read by itself.

Defined cases: a null or empty text is its end id alone. Null ids come first. Repeated rows are written
each; rows with equal ids are in an order of their texts' hashes. A document longer than a block is a
block of its own. An empty table gives files without blocks. A damaged block is an error when read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.codec import LANES, STEPS, decode_block, encode_block
from alertloom.llm.text import Texts
from alertloom.llm.tokens import crc32_of, tokenizer, vocabulary_path
from alertloom.session import scratch_dir

END = 0
BLOCK = LANES * STEPS


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END, block: int = BLOCK) -> None:
    """Write the ids of all documents to `folder`."""
    path = path or vocabulary_path()
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("mixed"))
    ordered = source.repartitionByRange("doc_id", "mixed").sortWithinPartitions("doc_id", "mixed")
    key = source.schema["doc_id"].dataType
    kind = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(key)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("n_ids", T.LongType()),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        names: list = []
        flat: list[np.ndarray] = []
        size = 0

        def made():
            nonlocal number, size
            lengths = [len(x) for x in flat]
            values = [[part], [number], [names], [lengths], [size], [encode_block(np.concatenate(flat))]]
            row = pa.RecordBatch.from_arrays(
                [pa.array(v, f) for v, f in zip(values, kinds)], names=[f.name for f in kind]
            )
            names.clear(), flat.clear()
            number, size = number + 1, 0
            return row

        for batch in batches:
            kinds = [pa.int64(), pa.int64(), pa.list_(batch.column(0).type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            keys = batch.column(0).to_pylist()
            for low, high, piece in Texts.of(batch.column(1)).slices():
                ids, at = tokenizer(path).encode(piece, end)
                for i in range(high - low):
                    mine = ids[at[i] : at[i + 1]]
                    if size and size + len(mine) > block:
                        yield made()
                    names.append(keys[low + i])
                    flat.append(mine)
                    size += len(mine)
        if flat:
            yield made()

    ordered.select("doc_id", "text").mapInArrow(run, kind).write.parquet(folder)


def _starts(blocks: DataFrame) -> DataFrame:
    """Per block: the number of ids in all blocks before it."""
    narrow = blocks.select("part", "block", "n_ids")
    # Parts follow each other; there is one row for each part to sum over.
    parts = narrow.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, rows = 0, []
    for r in sorted(parts, key=lambda r: r["part"]):
        rows.append((r["part"], before))
        before += r["n"]
    offsets = blocks.sparkSession.createDataFrame(rows, "part long, before long")
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long"))
    placed = narrow.withColumn("within", within).join(F.broadcast(offsets), "part")
    return placed.select("part", "block", (F.col("before") + F.col("within")).alias("before"))


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids."""
    blocks = spark.read.parquet(folder)
    key = blocks.schema["doc_ids"].dataType.elementType
    fields = [("part", T.LongType()), ("block", T.LongType()), ("doc_id", key)]
    fields += [(c, T.LongType()) for c in ("within", "n_tokens", "ids_crc32")]
    fields += [("ids", T.ArrayType(T.IntegerType()))] * ids
    kind = T.StructType([T.StructField(*f) for f in fields])
    # Decoding takes far longer than reading: blocks are dealt evenly first.
    dealt = blocks.select("part", "block", "doc_ids", "lengths", "data").repartition("part", "block")
    rows = dealt.mapInArrow(_decoded(ids), kind).join(_starts(blocks), ["part", "block"])
    start = (F.col("before") + F.col("within")).alias("start")
    return rows.select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * ids)


def _decoded(with_ids: bool):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids = decode_block(one.column(4)[0].as_py())
                lengths = np.array(one.column(3)[0].as_py(), np.int64)
                ends = np.cumsum(lengths)
                firsts = ends - lengths
                n = len(lengths)
                columns = [
                    pa.array(np.full(n, one.column(0)[0].as_py())),
                    pa.array(np.full(n, one.column(1)[0].as_py())),
                    one.column(2).flatten(),
                    pa.array(firsts),
                    pa.array(lengths),
                    pa.array([crc32_of(ids[a:b]) for a, b in zip(firsts, ends)], pa.int64()),
                ]
                names = ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    bounds = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the ids of `docs` to the shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(docs, folder, path)
    return read_ids(spark, folder, ids=False)
