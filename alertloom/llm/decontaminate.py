"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives windows of `WINDOW` consecutive words (one shorter window for a short
item). A window is contained in a document where all its words follow each other. Windows are sets of
shingles; since containment must be complete, one necessary token is a sufficient prefix: the window's
rarest shingle. Rarity is counted over all documents. Documents are joined with the prefix tokens only;
the token's place in its window bounds where the window must start and that it must end within the
document; then the shingles at the other places are compared, as many as hold all words of the window.

Windows are made in Spark tasks and all joins are shuffles. A filter of fixed size, made from the shingles of all
windows, is the only thing sent to all tasks: it keeps places in documents that no window can have from being written.

Defined cases: null texts have no words; they, and items without words, match nothing. Copies of
items each count. Items with a null id count under the empty id. Repeated documents each get a row.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.text import NOT_ALNUM, Texts, Words, append_columns, columns_of, free_prefix
from alertloom.session import settled, stored

WINDOW = 13
SHINGLE = 4
# Windows made at a time, and bits of the filter.
BLOCK = 5_000
FILTER_BITS = 24
# Contaminated from one hit word in twenty on.
HIT_SHARE = 20


@dataclass
class Windows:
    """Distinct windows of some items. `items[w]` has the ids of the items with window w."""

    words: list[np.ndarray] = field(default_factory=list)
    items: list[list[str]] = field(default_factory=list)

    @classmethod
    def of(cls, rows: list[tuple[str, np.ndarray]]) -> Windows:
        seen: dict[bytes, set[str]] = defaultdict(set)
        for item, words in rows:
            for i in range(max(1, len(words) - WINDOW + 1)):
                seen[words[i : i + WINDOW].tobytes()].add(item)
        keys = sorted(seen)
        return cls([np.frombuffer(k, np.uint64) for k in keys], [sorted(seen[k]) for k in keys])

    def shingles(self) -> dict[int, np.ndarray]:
        """By shingle length: the distinct shingles of all windows, sorted."""
        found = defaultdict(set)
        for w in self.words:
            k = min(SHINGLE, len(w))
            found[k].update(_shingles(w, k).tolist())
        return {k: np.array(sorted(v), np.uint64) for k, v in found.items()}


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    grams = object.__new__(Words)
    grams.hashes = words
    return grams.grams(k)


@dataclass
class Index:
    """Windows by their prefix token: `tokens[k]` sorted, `windows[k][t]` lists (window, place in it)."""

    block: Windows
    tokens: dict[int, np.ndarray]
    windows: dict[int, list[list[tuple[int, int]]]]

    @classmethod
    def of(cls, block: Windows, counts: dict[tuple[int, int], int]) -> Index:
        chosen = defaultdict(lambda: defaultdict(list))
        for number, w in enumerate(block.words):
            k = min(SHINGLE, len(w))
            grams = _shingles(w, k).tolist()
            place = min(range(len(grams)), key=lambda i: (counts.get((k, grams[i]), 0), grams[i]))
            chosen[k][grams[place]].append((number, place))
        tokens = {k: np.array(sorted(v), np.uint64) for k, v in chosen.items()}
        return cls(block, tokens, {k: [chosen[k][t] for t in v.tolist()] for k, v in tokens.items()})


def _windows(benchmark: DataFrame, block: int) -> DataFrame:
    """Distinct windows of the items: item, words, k (the shingle length). A task makes `block` of them at a time."""

    def run(batches):
        for batch in batches:
            for item, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                words = Words(Texts.of(pa.array([text], pa.string())), NOT_ALNUM, lower=True).hashes
                for i in range(0, max(1, len(words) - WINDOW + 1) if len(words) else 0, block):
                    made = Windows.of([(item, words[i : i + block + WINDOW - 1])]).words
                    columns = [
                        pa.array([item] * len(made), pa.string()),
                        pa.array([w.view(np.int64) for w in made], pa.list_(pa.int64())),
                        pa.array([min(SHINGLE, len(w)) for w in made], pa.int32()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "words", "k"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return named.where("text is not null").mapInArrow(run, "item string, words array<long>, k int").distinct()


def _block(column: pa.Array) -> Windows:
    words = [np.array(w, np.int64).view(np.uint64) for w in column.to_pylist()]
    return Windows(words, [[] for _ in words])


def _prefixes(windows: DataFrame) -> DataFrame:
    """Per window with its shingles' counts: words, k, tokens, and the prefix token and its place."""

    def run(batches):
        for batch in batches:
            block = _block(batch.column(0))
            counts = {}
            for k, pairs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                counts |= {(k, token & (2**64 - 1)): n for token, n in pairs}
            index = Index.of(block, counts)
            rows = []
            for k, tokens in index.tokens.items():
                for token, found in zip(tokens.tolist(), index.windows[k]):
                    if counts.get((k, token), 0):
                        rows += [(number, k, token, place) for number, place in found]
            words = [block.words[r[0]] for r in rows]
            columns = [
                pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([_shingles(w, r[1]).view(np.int64) for w, r in zip(words, rows)], pa.list_(pa.int64())),
                pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64)),
                pa.array([r[3] for r in rows], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["words", "k", "tokens", "token", "shift"])

    kind = "words array<long>, k int, tokens array<long>, token long, shift int"
    return windows.select("words", "k", "counts").mapInArrow(run, kind)


def _tokens(windows: DataFrame) -> DataFrame:
    """The distinct shingles of each window: words, k, token."""

    def run(batches):
        for batch in batches:
            words = batch.column(0)
            found = [Windows([w], [[]]).shingles() for w in _block(words).words]
            made = [next(iter(f.values())).view(np.int64) for f in found]
            columns = [words, batch.column(1), pa.array(made, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["words", "k", "tokens"])

    listed = windows.select("words", "k").distinct().mapInArrow(run, "words array<long>, k int, tokens array<long>")
    return listed.select("words", "k", F.explode("tokens").alias("token"))


def _filter(tokens: DataFrame) -> dict[int, np.ndarray]:
    """By shingle length: a table of flags, set for the low bits of the windows' shingles."""
    place = tokens.select("k", F.col("token").bitwiseAND((1 << FILTER_BITS) - 1).alias("low"))
    slot = place.select("k", F.shiftright("low", 6).alias("slot"), F.expr("shiftleft(1L, cast(low & 63 as int))").alias("flag"))
    out: dict[int, np.ndarray] = {}
    for r in slot.groupBy("k", "slot").agg(F.bit_or("flag").alias("flags")).collect():
        table = out.setdefault(r["k"], np.zeros(1 << (FILTER_BITS - 6), np.int64))
        table[r["slot"]] = r["flags"]
    return {k: np.unpackbits(v.astype("<i8").view(np.uint8), bitorder="little") for k, v in out.items()}


def _places(numbered: DataFrame, row: str, flags: dict[int, np.ndarray]) -> DataFrame:
    """Where shingles that pass the filter are in the documents: row, n_words, k, token, place."""
    packed = {k: np.packbits(v) for k, v in flags.items()}
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def run(batches):
        tables = {k: np.unpackbits(v).view(bool) for k, v in packed.items()}
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for low, _, part in Texts.of(batch.column(1)).slices():
                words = Words(part, NOT_ALNUM, lower=True)
                for k, table in tables.items():
                    grams = words.grams(k)
                    at = np.flatnonzero(table[grams & mask])
                    text = np.searchsorted(words.first, at, side="right") - 1
                    inside = at + k <= words.first[text + 1]
                    at, text = at[inside], text[inside]
                    columns = [rows[low + text], words.counts()[text], np.full(len(at), k, np.int32)]
                    columns += [grams[at].view(np.int64), at - words.first[text]]
                    for i in range(0, len(at), 100_000):
                        part_of = [pa.array(c[i : i + 100_000]) for c in columns]
                        yield pa.RecordBatch.from_arrays(part_of, names=["row", "n_words", "k", "token", "place"])

    kind = "row long, n_words long, k int, token long, place long"
    return numbered.select(F.col(row).alias("row"), "text").mapInArrow(run, kind)


def _matches(places: DataFrame, tokens: DataFrame) -> DataFrame:
    """Windows in documents: row, start, words."""
    counts = places.groupBy("k", "token").agg(F.count("*").alias("n"))
    rarity = tokens.join(counts, ["k", "token"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # A window with a shingle that no document has is in none.
    listed = rarity.groupBy("words", "k").agg(F.collect_list(F.struct("token", "n")).alias("pairs"), F.min("n").alias("least")).where("least > 0")
    prefix = _prefixes(listed.select("words", "k", F.map_from_entries("pairs").alias("counts")))
    begin = F.col("place") - F.col("shift")
    met = places.join(prefix, ["k", "token"]).where((begin >= 0) & (begin + F.size("words") <= F.col("n_words")))
    found = stored(met.select("row", begin.alias("start"), "words", "k", "tokens"))
    # Every k-th shingle and the last one hold all words of a window.
    last = F.size("tokens") - 1
    needed = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.col("k")), F.array(last)))
    apart = found.withColumn("needed", needed).select("*", F.explode("needed").alias("i"))
    wanted = apart.select("row", "start", "words", "k", F.size("needed").alias("all"), (F.col("start") + F.col("i")).alias("place"), F.col("tokens")[F.col("i")].alias("token"))
    held = wanted.join(places.drop("n_words"), ["row", "place", "k", "token"])
    return held.groupBy("row", "start", "words", "all").agg(F.count("*").alias("held")).where("held = all").select("row", "start", "words")


def _found(places: DataFrame, windows: DataFrame, tokens: DataFrame) -> DataFrame:
    """Per row with a window: spans (hit runs of words: start, end, start, ...) and items."""
    match = stored(_matches(places, tokens))
    runs = match.select("row", "start", (F.col("start") + F.size("words")).alias("end")).distinct()
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("new", F.coalesce((F.col("start") > before).cast("long"), F.lit(0)))
    run = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = run.groupBy("row", "run").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    listed = whole.groupBy("row").agg(F.array_sort(F.collect_list(F.array("a", "b"))).alias("pairs"))
    spans = listed.select("row", F.flatten("pairs").alias("spans"))
    named = match.select("row", "words").distinct().join(windows.select("words", "item"), "words").select("row", "item").distinct()
    items = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return spans.join(items, "row")


def _search(docs: DataFrame, benchmark: DataFrame, row: str, block: int) -> DataFrame:
    windows = stored(_windows(benchmark, block))
    tokens = stored(_tokens(windows))
    return stored(_found(stored(_places(docs, row, _filter(tokens))), windows, tokens))


def _counted(docs: DataFrame, prefix: str) -> DataFrame:
    def compute(batch):
        texts = Texts.of(batch.column("text"))
        counts = np.zeros(len(texts), np.int64)
        for low, high, part in texts.slices():
            counts[low:high] = Words(part, NOT_ALNUM, lower=True).counts()
        return [counts]

    return append_columns(docs, T.StructType([T.StructField("n_words", T.LongType())]), compute, prefix)


def find_items(docs: DataFrame, benchmark: DataFrame, prefix: str = "", block: int = BLOCK) -> DataFrame:
    """Every row of `docs` with n_words, spans (hit runs of words: start, end, start, ...) and items.

    What is not read from plain files is written once: rows are numbered and found again by number.
    """
    docs = settled(docs)
    row = free_prefix(docs) + "row"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = _search(numbered, benchmark, row, block)
    return _joined(_counted(numbered, prefix), found, row, prefix)


def _joined(counted: DataFrame, found: DataFrame, row: str, prefix: str) -> DataFrame:
    none = {"spans": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
    named = found.select(F.col("row").alias(row), *[F.col(c).alias(prefix + c) for c in none])
    both = counted.join(named, row, "left").drop(row)
    return both.withColumns({prefix + c: F.coalesce(F.col(prefix + c), v) for c, v in none.items()})


def contamination(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    numbered = settled(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id())
    found = _search(numbered, benchmark, "row", block)
    # Texts stay where they are: only counts meet what was found.
    return summary(_joined(_counted(numbered, "").drop("text"), found, "row", "")).drop("spans", "items")


def summary(found: DataFrame, prefix: str = "") -> DataFrame:
    fields = T.StructType(
        [
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )
    spans, n = F.col(f"{prefix}spans"), F.col(f"{prefix}n_words")
    items = F.array_sort(F.col(f"{prefix}items"))
    # Starts have even places: a run adds its end and takes off its start.
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    hit = F.aggregate(signed, F.lit(0).cast("long"), lambda a, b: a + b)
    made = [
        hit,
        F.size(items).cast("long"),
        F.sha2(F.concat_ws(",", items), 256),
        (hit > 0) & (HIT_SHARE * hit >= n),
    ]
    return found.withColumns({prefix + f.name: c for f, c in zip(fields, made)})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their columns."""
    docs = settled(docs)
    row = free_prefix(docs) + "row"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = _search(numbered, benchmark, row, block)
    counted = _counted(numbered.select("text", row), "").drop("text")
    judged = summary(_joined(counted.withColumn("r", F.col(row)), found, row, "")).where("contaminated")
    bad = stored(judged.select(F.col("r").alias(row)))
    return numbered.join(bad, row, "left_anti").select(*columns_of(docs))
