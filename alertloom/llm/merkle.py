"""A Merkle manifest of a dataset: a root over all rows, and for every row the siblings that prove it.

Rows are leaves in the order of doc_id within their source. A source's tree has runs of three: every three
consecutive nodes become one, the last run may be shorter, until one node is left. The sources' roots, in order of
source, are the leaves of one more tree of this kind, whose root stands for the dataset.

Leaves are appended to a `Stack` of open subtrees. An open subtree carries a witness for each of its leaves: the
siblings met so far, in order. When a run completes, the witnesses of its nodes' leaves are extended by the other
nodes of the run. A task appends one block of 3**6 aligned leaves, so it holds one block and the open subtrees.
A block's root is a leaf of the next level, where it is appended in turn: with their own witnesses, block roots
complete those of their leaves. So a source with a third of all rows is many blocks, and the number of levels of blocks
grows with its logarithm. A witness is a row's digests of 32 bytes, one after the other; their places follow from
the row's number and the number of rows.

Defined cases: a null value is `-` in the leaf. A null source is a source of its own and the first. Null ids come
first. Rows with equal ids are in the order of their leaves; equal rows are interchangeable, and each is a leaf. A
source of one row is its own root. An empty table gives no rows. A missing one of the leaf's columns is an error, other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.order import numbered
from alertloom.session import stored

RUN = 3
# Levels of a block, which has RUN ** LEVELS leaves.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SIZE = 32


def digest(parts: list[bytes]) -> bytes:
    """Of the parts' hexadecimal texts, one after the other."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


class Stack:
    """The open subtrees of a growing tree, from the lowest level up."""

    def __init__(self, run: int = RUN):
        self.run = run
        # Per level: the nodes of the run that is not complete, each with its leaves' witnesses.
        self.open: list[list[tuple[bytes, list[bytearray]]]] = [[]]

    def append(self, leaf: bytes) -> bytearray:
        """Add a leaf; its witness, which later leaves extend."""
        witness = bytearray()
        self._add(0, leaf, [witness])
        return witness

    def _add(self, level: int, node: bytes, witnesses: list[bytearray]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, witnesses))
        if len(self.open[level]) == self.run:
            self._join(level)

    def _join(self, level: int) -> None:
        nodes, self.open[level] = self.open[level], []
        every: list[bytearray] = []
        for i, (_, witnesses) in enumerate(nodes):
            siblings = b"".join(n for j, (n, _) in enumerate(nodes) if j != i)
            for w in witnesses:
                w += siblings
            every += witnesses
        self._add(level + 1, digest([n for n, _ in nodes]), every)

    def close(self, levels: int | None = None) -> bytes:
        """Complete what is open, up to one node, or to the given level if the tree goes on above."""
        level = 0
        while level != levels and not (levels is None and self._is_root(level)):
            if self.open[level]:
                self._join(level)
            level += 1
        return self.open[level][0][0]

    def _is_root(self, level: int) -> bool:
        return len(self.open[level]) == 1 and not any(self.open[level + 1 :])


def fold(node: bytes, number: int, count: int, witness: bytes, run: int = RUN) -> bytes:
    """The root that a leaf and its witness lead to; `number` is the leaf's, `count` that of all leaves."""
    at = 0
    while count > 1:
        place = number % run
        others = min(run, count - (number - place)) - 1
        parts = [witness[at + _SIZE * i : at + _SIZE * (i + 1)] for i in range(others)]
        parts.insert(place, node)
        node = digest(parts)
        at += _SIZE * others
        number, count = number // run, -(-count // run)
    return node


def _value(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column | None = None) -> Column:
    """The digest of a row's values, each with its length."""
    values = [_value(F.col(c) if c != "text" or text is None else text) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*values), 256))


def grow(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """`nodes` (tree, number, count, node, and more) with each node's `witness` and its tree's `root`.

    `count` is the number of the tree's nodes, `number` the node's place among them.
    """
    size = RUN**levels
    own = ["tree", "number", "count"]
    more = [c for c in nodes.columns if c not in own]
    now, made = nodes, []
    while True:
        source = now.select(*own, *(more if not made else ["node"]), F.expr(f"number div {size}").alias("block"))
        # Rows of a block meet in one task, which holds one block of at most `size` rows at a time.
        dealt = source.repartition("tree", "block").sortWithinPartitions("tree", "number")
        kinds = T.StructType([*source.schema, *(T.StructField(c, T.BinaryType()) for c in ("witness", "top"))])
        made.append(stored(dealt.mapInArrow(_blocks(size, levels), kinds)))
        roots = made[-1].where((F.col("number") % size == 0) & (F.col("count") > size))
        if roots.isEmpty():
            break
        blocks = F.expr(f"(count + {size - 1}) div {size}").alias("count")
        now = roots.select("tree", F.col("block").alias("number"), blocks, F.col("top").alias("node"))
    # From the top down: what a block's root has found completes its leaves.
    above = made[-1].withColumnRenamed("top", "root")
    for here in reversed(made[:-1]):
        up = above.select("tree", F.col("number").alias("block"), F.col("witness").alias("rest"), "root")
        joined = here.alias("h").join(up.alias("u"), F.expr("h.tree <=> u.tree and h.block = u.block"), "left")
        above = joined.select(
            *(F.col(f"h.{c}") for c in here.columns if c not in ("witness", "top")),
            F.concat("h.witness", F.coalesce("rest", F.lit(b""))).alias("witness"),
            F.coalesce("root", "top").alias("root"),
        )
    return above.drop("block")


def _blocks(size: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, witnesses, stack = None, [], [], Stack()

        def closed():
            rows = pa.Table.from_batches(pieces).combine_chunks()
            top = stack.close(levels if rows["count"][0].as_py() > size else None)
            rows = rows.append_column("witness", pa.array([bytes(w) for w in witnesses], pa.binary()))
            return rows.append_column("top", pa.array([top] * len(witnesses), pa.binary())).to_batches()

        for batch in batches:
            low = 0
            for i, (tree, block, node) in enumerate(zip(*(batch[c].to_pylist() for c in ("tree", "block", "node")))):
                if key != (tree, block):
                    if key is not None:
                        pieces.append(batch.slice(low, i - low))
                        yield from closed()
                    key, pieces, witnesses, stack, low = (tree, block), [], [], Stack(), i
                witnesses.append(stack.append(node))
            pieces.append(batch.slice(low))
        if key is not None:
            yield from closed()

    return run


def manifest(docs: DataFrame, levels: int = LEVELS, changed: Column | None = None) -> DataFrame:
    """Per row: doc_id, source, number, count, leaf, subroot, root, and its witnesses in the source and above.

    `changed`, if given, is another text; `other` is then the leaf with it.
    """
    other = leaf_of(changed) if changed is not None else F.lit(None).cast("binary")
    leaves = docs.select("doc_id", "source", leaf_of().alias("leaf"), other.alias("other"))
    # Equal rows are told apart by a number of their own, so that many of them are not one key of the sort.
    leaves = stored(leaves.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())))
    ordered = numbered(leaves, ["source", "doc_id", "leaf", "salt"], "place")
    sources = stored(ordered.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("count")))
    joined = ordered.alias("o").join(sources.alias("s"), F.expr("o.source <=> s.source"))
    rows = joined.select(
        F.col("o.source").alias("tree"), (F.col("place") - F.col("first")).alias("number"), "count",
        F.col("leaf").alias("node"), "doc_id", "other",
    )
    trees = grow(rows, levels).withColumnsRenamed({"tree": "source", "node": "leaf", "root": "subroot"})
    trees = stored(trees)
    # One leaf of the upper tree for each source.
    tops = numbered(trees.where("number = 0").select("source", F.col("subroot").alias("node")), ["source"], "number")
    upper = grow(tops.withColumns({"tree": F.lit(0), "count": F.lit(sources.count()).cast("long")}), levels)
    upper = stored(upper.select(
        "source", F.col("number").alias("source_number"), F.col("count").alias("sources"),
        F.col("witness").alias("upper_witness"), "root",
    ))
    joined = trees.alias("t").join(upper.alias("u"), F.expr("t.source <=> u.source"))
    return joined.select("t.*", *(f"u.{c}" for c in upper.columns if c != "source"))


def verified(proofs: DataFrame) -> DataFrame:
    """`proofs`, a manifest, with `folded`: the root that `other`, or else the leaf, and the witnesses lead to."""
    source = proofs.withColumn("start", F.coalesce("other", "leaf"))
    names = ["start", "number", "count", "witness", "source_number", "sources", "upper_witness"]
    rest = [c for c in proofs.columns if c not in names]
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for start, number, count, witness, place, sources, upper in zip(*(batch.column(n).to_pylist() for n in names)):
                out.append(fold(fold(start, number, count, witness), place, sources, upper))
            columns = [*(batch.column(c) for c in rest), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "folded"])

    # The proof itself stays in the JVM: it is only digested there.
    return source.select(*names, *rest).mapInArrow(run, f"{fields}, folded binary")


def tampered_text() -> Column:
    """Of every second row, by the checksum of its id, the text without its line ends."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def proof_report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    text = lambda c: F.lower(F.hex(c))
    proofs = manifest(docs, levels, tampered_text())
    proofs = proofs.withColumn("proof_sha256", F.sha2(text(F.concat("witness", "upper_witness")).cast("binary"), 256))
    folded = verified(proofs)
    return folded.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), "proof_sha256",
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
