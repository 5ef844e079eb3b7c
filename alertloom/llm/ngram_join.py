"""Jaccard join of documents by their word 4-grams, after the size-aware heavy-light method.

A document is the set of its shingles; two link when 100 * |A and B| >= 85 * |A or B|. Equal sets are
first made one class. Sets of up to a boundary size are light, others heavy:

* Light pairs share a subset of the size that their sizes require. All subsets of those sizes are
  enumerated; equal subsets are links, with nothing left to verify.
* A heavy set finds its partners in inverted lists. Only the rarest shingles of a set are listed, as many
  as a partner cannot lack all of. Light sets large enough to be a heavy set's partner are listed too.

The boundary is the size at which enumerating costs more than listing, given how many sets there
are of each size. Rarity comes from counts over all documents in a table of fixed size, where rare
shingles that meet a frequent one look frequent; any order finds the same links, only at another cost.

For groups of links (`jaccard_components`) not every pair is needed. In each list, members are first
compared with one member chosen by a hash of the shingle, then those outside the list's largest group with a
few of that group. Last, every pair that is still in different groups is compared, so no link is lost. Pairs whose sizes, places in the order or parity bits already rule a
link out are not compared. Comparing means intersecting whole sets, of whole texts.

A list that holds more than one in `PIECES` of all entries is dealt over salts, as many as its count asks for, wherever
lists are joined. There are fewer such lists than `PIECES`, so their salts are sent to all tasks.

Defined cases: null or empty texts and texts without words have no shingles and link with nothing;
their group is their own id. Texts with fewer words than a shingle have one, their whole sequence.
What is not read from plain files is written once: rows are numbered and found again by number.
A group's id is its smallest non-null doc_id. Equal texts always link. Only doc_id and text are read.
Shingles are compared by 64-bit hashes, classes by two of these.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.graph import components
from alertloom.llm.text import SPACE, Texts, Words, columns_of, mix, release
from alertloom.session import settled, stored

SHINGLE = 4
# The threshold as a fraction, so that it is compared in whole numbers.
PERCENT = 85
LARGEST_LIGHT = 32
VERIFY_COST = 8
# Members of a list's largest group that others in the list are compared with before all pairs are.
LEADERS = 4
# No task gets more of a list than one in so many of all entries.
PIECES = 4096
BIT_WORDS = 8


def required(n: int, m: int, percent: int = PERCENT) -> int:
    """The least overlap of sets of these sizes that link."""
    return -(-percent * (n + m) // (100 + percent))


def listed(n: int, percent: int = PERCENT) -> int:
    """How many of a set's rarest shingles are listed."""
    return n - (-(-percent * n // 100)) + 1


def subset_sizes(n: int, boundary: int, percent: int = PERCENT) -> list[int]:
    """The overlaps that a light set of size n may need with a light partner."""
    partners = range(-(-percent * n // 100), min(boundary, 100 * n // percent) + 1)
    return sorted({required(n, m, percent) for m in partners})


def shingle_sets(texts: Texts, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    out = []
    for _, _, part in texts.slices():
        words = Words(part, SPACE, lower=True)
        grams = words.grams(k)
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            if b - a >= k:
                out.append(np.unique(grams[a : b - k + 1]))
            elif b > a:
                out.append(np.array([words.whole(i)], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


@dataclass
class Rarity:
    """Log-scaled counts of shingles by their low bits, and how many sets have each size up to LARGEST_LIGHT."""

    counts: np.ndarray
    sizes: np.ndarray
    heavier: int

    def order(self, tokens: np.ndarray) -> np.ndarray:
        """The tokens from rare to frequent, ties by hash."""
        bits = np.uint64(len(self.counts) - 1)
        return tokens[np.lexsort((tokens, self.counts[tokens & bits]))]


_CHUNK = 1 << 14


def count_shingles(docs: DataFrame, k: int = SHINGLE) -> Rarity:
    """Counts over all documents in a table whose size follows the number of documents, up to 16 MB."""
    bits = int(np.clip(math.ceil(math.log2(max(docs.count(), 1) * 4)), 14, 24))

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        sizes = np.zeros(LARGEST_LIGHT + 2, np.uint32)
        low = np.uint64((1 << bits) - 1)
        for batch in batches:
            sets = shingle_sets(Texts.of(batch.column(0)), k)
            for i in range(0, len(sets), 512):
                total += np.bincount(np.concatenate(sets[i : i + 512]) & low, minlength=1 << bits).astype(np.uint32)
            sizes += np.bincount([min(len(s), LARGEST_LIGHT + 1) for s in sets], minlength=len(sizes)).astype(np.uint32)
        parts = [sizes, *total.reshape(-1, _CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(parts) - 1), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["chunk", "data"],
        )
        release()

    def add(kind):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x, kind).astype(np.int64) for x in frame["data"])
            return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "data": [total.tobytes()]})

        return run

    def scaled(frame: pd.DataFrame) -> pd.DataFrame:
        out = add(np.int64)(frame)
        if out["chunk"].iloc[0] >= 0:
            total = np.frombuffer(out["data"].iloc[0], np.int64)
            out["data"] = [np.round(4 * np.log2(total + 1.0)).astype(np.uint8).tobytes()]
        return out

    kind = "chunk int, data binary"
    counted = docs.select("text").mapInArrow(count, kind)
    # Two steps, so that no group grows with the number of tasks.
    summed = counted.withColumn("part", F.spark_partition_id() % 64).groupBy("chunk", "part").applyInPandas(add(np.uint32), kind)
    rows = {r["chunk"]: r["data"] for r in summed.groupBy("chunk").applyInPandas(scaled, kind).collect()}
    sizes = np.frombuffer(rows.get(-1, bytes(8 * (LARGEST_LIGHT + 2))), np.int64)
    empty = bytes(_CHUNK)
    counts = b"".join(rows.get(i, empty) for i in range((1 << bits) // _CHUNK))
    return Rarity(np.frombuffer(counts, np.uint8), sizes[:-1], int(sizes[-1]))


def boundary(sizes: np.ndarray, percent: int = PERCENT) -> int:
    """The largest light size, by the least total cost of enumerating and listing."""

    def cost(x: int) -> int:
        total = 0
        for n in range(1, len(sizes)):
            lists = (1 + VERIFY_COST) * listed(n, percent)
            if n <= x:
                total += int(sizes[n]) * sum(math.comb(n, c) for c in subset_sizes(n, x, percent))
            if n > x or 100 * n >= percent * (x + 1):
                total += int(sizes[n]) * lists
        return total

    return min(range(len(sizes)), key=cost)


def _bits(tokens: np.ndarray) -> np.ndarray:
    odd = np.bincount((tokens % np.uint64(64 * BIT_WORDS)).astype(np.int64), minlength=64 * BIT_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_BITS = [f"b{i}" for i in range(BIT_WORDS)]


def _with_sets(docs: DataFrame, rarity: Rarity, light: int, k: int, percent: int) -> DataFrame:
    """Per document: its row, id, set size, two set hashes, parity bits and the tokens to list (all, if light)."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    fields = [source.schema["row"], source.schema["doc_id"]]
    fields += [T.StructField(c, T.LongType()) for c in ("n", "s1", "s2", *_BITS)]
    fields += [T.StructField("tokens", T.ArrayType(T.LongType()))]

    def run(batches):
        order = shared.value.order
        for batch in batches:
            sets = shingle_sets(Texts.of(batch.column(2)), k)
            chosen = [order(s)[: len(s) if len(s) <= light else listed(len(s), percent)] for s in sets]
            with np.errstate(over="ignore"):
                one = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                two = [int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            bits = np.array([_bits(s) for s in sets], np.int64).reshape(len(sets), BIT_WORDS)
            ends = np.concatenate([[0], np.cumsum([len(c) for c in chosen])]).astype(np.int32)
            flat = np.concatenate([*chosen, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    *[pa.array(b) for b in bits.T],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=[f.name for f in fields],
            )
        release()

    return source.mapInArrow(run, T.StructType(fields))


def _light_links(classes: DataFrame, light: int, percent: int) -> DataFrame:
    """Links of light sets with the smallest set that has a subset in common.

    Two sets that link have a common subset of the size they require; the smallest set with that subset
    requires no more of either, so both link to it.
    """

    def run(batches):
        for batch in batches:
            nodes, sizes, keys, need = [], [], [], []
            for node, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                full = np.sort(np.array(tokens, np.int64).view(np.uint64))
                for c in subset_sizes(len(full), light, percent):
                    rows = np.array(list(combinations(range(len(full)), c)))
                    with np.errstate(over="ignore"):
                        sums = mix(mix(full[rows]).sum(axis=1, dtype=np.uint64) + np.uint64(c))
                    keys += sums.view(np.int64).tolist()
                    need += [c] * len(sums)
                    nodes += [node] * len(sums)
                    sizes += [len(full)] * len(sums)
            yield pa.RecordBatch.from_pydict({"key": keys, "need": need, "n": sizes, "node": nodes}, schema=kind)

    kind = pa.schema([(c, pa.int64()) for c in ("key", "need", "n", "node")])
    subsets = classes.where(F.col("n") <= light).select("node", "tokens").mapInArrow(run, "key long, need long, n long, node long")
    first = subsets.groupBy("key", "need").agg(F.min(F.struct("n", "node")).alias("first"), F.count("*").alias("c"))
    joined = subsets.join(first.where("c > 1"), ["key", "need"])
    enough = F.col("need") >= F.ceil((F.col("n") + F.col("first.n")) * percent / (100 + percent))
    return joined.where(F.expr("node != first.node") & enough).select(F.col("node").alias("a"), F.col("first.node").alias("b"))


def _dealt(entries: DataFrame, pieces: int = PIECES) -> DataFrame:
    """The entries of lists with two members or more, each with its list's number of `salts` and its own `salt`."""
    often = stored(entries.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"))
    total = often.agg(F.sum("c")).first()[0] or 0
    sized = often.select("token", F.ceil(F.col("c") / max(1, -(-total // pieces))).cast("int").alias("salts"))
    # Fewer than `pieces` lists are larger than one in `pieces` of all entries.
    large = F.broadcast(sized.where("salts > 1"))
    salts = F.coalesce("salts", F.lit(1))
    salt = F.pmod(F.xxhash64("node"), salts.cast("bigint")).cast("int")
    drawn = entries.join(large, "token", "left").withColumns({"salts": salts, "salt": salt})
    return drawn.join(_in_each(sized).drop("salts"), ["token", "salt"])


def _in_each(lists: DataFrame) -> DataFrame:
    """Each row once for every salt of its list."""
    return lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def _listed(classes: DataFrame, light: int, percent: int) -> DataFrame:
    """The entries of all inverted lists with two members or more."""
    listable = classes.where((F.col("n") > light) | (100 * F.col("n") >= percent * (light + 1)))
    length = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    entries = listable.select("node", "n", F.posexplode(F.slice("tokens", F.lit(1), length.cast("int"))).alias("pos", "token"))
    return stored(_dealt(entries))


def _need(a: str, b: str, percent: int) -> Column:
    return F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * percent / (100 + percent))


def _may_link(a: str, b: str, percent: int) -> Column:
    """False only for pairs that cannot link: by their sizes, or by the token's places in the order."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    both = F.least(f"{a}.pos", f"{b}.pos") + 1 + F.least(n - F.col(f"{a}.pos") - 1, m - F.col(f"{b}.pos") - 1)
    fits = (100 * n >= percent * m) & (100 * m >= percent * n)
    return fits & (both >= _need(a, b, percent))


def _bits_allow(a: str, b: str, percent: int) -> Column:
    """False only for pairs that cannot link: each parity bit that differs is a shingle that one set lacks."""
    apart = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in _BITS)
    return apart <= F.col(f"{a}.n") + F.col(f"{b}.n") - 2 * _need(a, b, percent)


def _pair(a: str, b: str) -> list[Column]:
    x, y = F.col(f"{a}.node"), F.col(f"{b}.node")
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _star_pairs(entries: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Each list's members with one of them, another one for each list of the same members."""
    chosen = F.min_by(F.struct("node", "n", "pos", "salts"), F.struct(F.xxhash64("token", "node"), "node"))
    leaders = _in_each(entries.groupBy("token").agg(chosen.alias("l")).select("token", "l.*"))
    others = F.expr("x.token = l.token and x.salt = l.salt and x.node != l.node")
    pairs = entries.alias("x").join(leaders.alias("l"), others & _may_link("x", "l", percent))
    found = pairs.select(*_pair("x", "l")).distinct()
    known = found.join(bits.alias("x"), F.col("a") == F.col("x.node")).join(bits.alias("y"), F.col("b") == F.col("y.node"))
    return known.where(_bits_allow("x", "y", percent)).select("a", "b")


def _mixed(entries: DataFrame, bits: DataFrame, least: int) -> DataFrame:
    """Lists of `least` members or more in several groups, with each list's largest group as `main`, and bits."""
    sizes = entries.groupBy("token", "group").agg(F.count("*").alias("c"), F.max("salts").alias("salts"))
    lists = sizes.groupBy("token").agg(
        F.max_by("group", F.struct("c", "group")).alias("main"),
        F.max("salts").alias("salts"),
        F.count("*").alias("groups"),
        F.sum("c").alias("size"),
    )
    chosen = lists.where((F.col("groups") > 1) & (F.col("size") >= least)).select("token", "main", "salts")
    return stored(entries.join(_in_each(chosen).drop("salts"), ["token", "salt"]).join(bits.drop("n"), "node"))


def _main_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """In mixed lists, the members outside the largest group with a few of that group."""
    kept = [c for c in mixed.columns if c not in ("token", "group", "main", "salt")]
    picked = [F.min_by(F.struct(*kept), F.struct(F.xxhash64("token", "node", F.lit(i)), "node")) for i in range(LEADERS)]
    leaders = mixed.where("group = main").groupBy("token").agg(F.array_distinct(F.array(*picked)).alias("l"))
    leaders = _in_each(leaders.select("token", F.explode("l").alias("l")).select("token", "l.*"))
    rest = mixed.where("group != main").alias("x")
    possible = _may_link("x", "l", percent) & _bits_allow("x", "l", percent)
    pairs = rest.join(leaders.alias("l"), F.expr("x.token = l.token and x.salt = l.salt") & possible)
    return pairs.select(*_pair("x", "l")).distinct()


def _cross_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """All pairs of a mixed list that are in different groups: members outside its largest with all others."""
    rest = _in_each(mixed.where("group != main")).alias("x")
    once = F.expr("x.token = y.token and x.salt = y.salt and x.group != y.group and (y.group = y.main or x.node < y.node)")
    possible = _may_link("x", "y", percent) & _bits_allow("x", "y", percent)
    return rest.join(mixed.alias("y"), once & possible).select(*_pair("x", "y")).distinct()


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link, by intersecting their whole sets."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    rows = classes.select("node", "row").join(nodes, "node")
    source = docs.select(F.monotonically_increasing_id().alias("row"), "text").join(rows, "row").select("node", "text")

    def tokenise(batches):
        for batch in batches:
            sets = shingle_sets(Texts.of(batch.column(1)), k)
            data = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data], names=["node", "tokens"])
        release()

    sets = stored(source.mapInArrow(tokenise, "node long, tokens binary"))

    def compare(batches):
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            keep = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


@dataclass
class _Prepared:
    sets: DataFrame
    classes: DataFrame
    entries: DataFrame
    light: DataFrame


def _prepare(docs: DataFrame, k: int, percent: int) -> _Prepared:
    rarity = count_shingles(docs, k)
    light = boundary(rarity.sizes, percent)
    sets = stored(_with_sets(docs, rarity, light, k, percent))
    picked = [F.first(c).alias(c) for c in (*_BITS, "tokens")]
    grouped = sets.where("n > 0").groupBy("n", "s1", "s2")
    classes = stored(
        grouped.agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), *picked).withColumn(
            "node", F.monotonically_increasing_id()
        )
    )
    entries = _listed(classes, light, percent)
    return _Prepared(sets, classes, entries, stored(_light_links(classes, light, percent)))


def jaccard_links(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The whole join: all links (a, b) between classes of equal sets, and the classes of the documents.

    The second table has node and doc_id for each document with a shingle. Links number up to the
    square of a group of near copies; where only the groups matter, use `jaccard_components`.
    """
    docs = settled(docs.select("doc_id", "text"))
    p = _prepare(docs, k, percent)
    bits = p.classes.select("node", "n", *_BITS)
    alone = p.entries.withColumn("group", F.col("node"))
    pairs = stored(_cross_pairs(_mixed(alone, bits, 2), percent))
    # The light links found lead to the smallest set only; for all pairs, light sets are listed too.
    light = p.light.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    small = p.classes.where(F.col("n") <= LARGEST_LIGHT)
    lists = small.select("node", "n", F.posexplode("tokens").alias("pos", "token"))
    length = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    lists = _dealt(lists.where(F.col("pos") < length)).withColumn("group", F.col("node"))
    every = stored(pairs.union(_cross_pairs(_mixed(lists, bits, 2), percent)).distinct())
    links = _linked(docs, p.classes, every, k, percent).union(light).distinct()
    members = p.sets.where("n > 0").join(p.classes.select("n", "s1", "s2", "node"), ["n", "s1", "s2"])
    return links, members.select("node", "doc_id")


def _groups(p: _Prepared, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) for every class with a link.

    Three rounds: one member of each list with all others, which is all there is to compare in lists of two;
    what is left outside a list's largest group with a few of that group; every pair still in
    different groups.
    """
    bits = p.classes.select("node", "n", *_BITS)
    done = stored(_star_pairs(p.entries, bits, percent))
    found = stored(components(_linked(docs, p.classes, done, k, percent).union(p.light)))
    for compared in (_main_pairs, _cross_pairs):
        grouped = p.entries.join(found, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
        pairs = stored(compared(_mixed(grouped, bits, 3), percent).join(done, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        links = _linked(docs, p.classes, pairs, k, percent)
        found = stored(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links)))
        done = done.union(pairs)
    return found


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, and whether it is the row that stands for its group.

    Runs jobs when called; several steps are written to the shared folder.
    """
    return _labelled(settled(docs.select("doc_id", "text")), k, percent).drop("row")


def _labelled(docs: DataFrame, k: int, percent: int) -> DataFrame:
    p = _prepare(docs, k, percent)
    classes = p.classes.select("n", "s1", "s2", "node", "doc_id", "row")
    grouped = classes.join(_groups(p, docs, k, percent), "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("first")
    best = stored(grouped.groupBy("component").agg(first).select("component", "first.doc_id", "first.row"))
    named = grouped.select("n", "s1", "s2", "component").join(
        best.select("component", F.col("doc_id").alias("component_id"), F.col("row").alias("kept_row")), "component"
    )
    rows = p.sets.select("row", "doc_id", "n", "s1", "s2").join(named.drop("component"), ["n", "s1", "s2"], "left")
    empty = F.col("n") == 0
    return rows.select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | (F.col("row") == F.col("kept_row"))).alias("is_kept"),
    )


def drop_near_copies(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group, that with the smallest doc_id; documents without shingles all stay."""
    name = "row"
    while name in docs.columns:
        name = f"_{name}"
    docs = settled(docs)
    kept = _labelled(docs, k, percent).where("is_kept").select(F.col("row").alias(name))
    numbered = docs.withColumn(name, F.monotonically_increasing_id())
    return numbered.join(kept, name, "left_semi").select(*columns_of(docs))
