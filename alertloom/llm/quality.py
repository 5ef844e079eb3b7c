"""Quality rules: gradient-boosted trees over statistics of a text.

Statistics are computed for whole texts in one map-only pass. A small boosted model is fitted in numpy on
a bounded sample of labelled texts (`SAMPLE` rows, chosen by a hash of the id), flattened into node
arrays and sent to the tasks, which walk all rows of a batch down a tree at once. Chosen statistics
carry a direction: quality never rises with them (see `FALLING`).

Defined cases: a null or empty text has no words and fails the base rule. Ties, copies and repeated
rows are judged each by its own text. Without labels, or with one class only, the model is a constant
and the base rule decides alone. Columns of the input other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.text import SPACE, Texts, Words, append_columns, byte_set, columns_of, free_prefix

SAMPLE = 20_000
ROUNDS, DEPTH, RATE, BINS, LEAF = 60, 3, 0.15, 64, 20

# Fixed values of the base rule.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_BLANK = b" \t\n\x0b\x0c\r"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "words_per_line",
]
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = byte_set([(0x41, 0x5A)])
_DIGIT = byte_set([(0x30, 0x39)])
_MARK = np.zeros(256, bool)
_MARK[list(b"!?:;=@/\\^~_{}[]()")] = True


def statistics(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The base counts (a row per text, columns BASE) and the model's features (columns FEATURES)."""
    counts = np.zeros((len(texts), len(BASE)), np.int64)
    features = np.zeros((len(texts), len(FEATURES)))
    for low, high, part in texts.slices():
        counts[low:high], features[low:high] = _statistics(part)
    return counts, features


def _statistics(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, SPACE)
    n = words.counts()
    chars = texts.per_text(words.inside & ((texts.data & 0xC0) != 0x80))
    symbols = texts.per_text(_SYMBOL[texts.data])
    repeated, distinct = _repeated(words)
    lines, dup = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        if n[i]:
            full = [x for x in texts.raw(i).split(b"\n") if x.strip(_BLANK)]
            lines[i], dup[i] = len(full), len(full) - len(set(full))
    counts = np.stack([n, chars, symbols, dup, repeated], axis=1)
    some, letters = np.maximum(n, 1), np.maximum(chars, 1)
    features = np.stack(
        [
            np.log1p(n),
            chars / some,
            symbols / letters,
            dup / np.maximum(lines, 1),
            repeated / some,
            texts.per_text(_UPPER[texts.data]) / letters,
            texts.per_text(_DIGIT[texts.data]) / letters,
            texts.per_text(_MARK[texts.data]) / letters,
            distinct / some,
            n / np.maximum(lines, 1),
        ],
        axis=1,
    )
    return counts, features


def _repeated(words: Words, k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words covered by k-word windows that occur twice or more, and distinct words."""
    grams, first = words.grams(k), words.first
    covered = np.zeros(len(first) - 1, np.int64)
    distinct = np.zeros(len(first) - 1, np.int64)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if a == b:
            continue
        distinct[i] = len(np.unique(words.hashes[a:b]))
        if b - a <= k:
            continue
        here = grams[a : b - k + 1]
        order = np.argsort(here)
        ranked = here[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            continue
        twice = np.zeros(len(here), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(b - a, bool)
        for j in range(k):
            hit[j : j + len(twice)] |= twice
        covered[i] = hit.sum()
    return covered, distinct


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself. `roots` has each tree's first node."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for each row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total


def fit(x: np.ndarray, y: np.ndarray, falling: tuple[str, ...] = FALLING) -> Trees:
    """Boosted trees for the log-loss on histograms; monotone in the features named by `falling`."""
    share = y.mean() if len(y) else 1.0
    if not 0 < share < 1:
        start = 0.0 if not len(y) else (10.0 if share else -10.0)
        zero = np.zeros(1, np.int64)
        return Trees(zero[:0], zero, np.zeros(1), zero, zero, np.zeros(1), 0, start)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    signs = np.array([-1 if f in falling else 0 for f in FEATURES])
    score = np.full(len(y), np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    start = float(score[0])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        roots.append(len(nodes))
        _grow(nodes, np.arange(len(y)), 0, (-np.inf, np.inf), binned, cuts, signs, gradient, weight, score)
    table = np.array(nodes)
    links = table[:, [0, 2, 3]].astype(np.int64)
    return Trees(np.array(roots), links[:, 0], table[:, 1], links[:, 1], links[:, 2], table[:, 4], DEPTH, start)


def _step(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
    return RATE * g / (h + 1.0)


def _grow(nodes, rows, depth, bounds, binned, cuts, signs, gradient, weight, score) -> int:
    """Add the subtree over `rows`; returns its node. Values stay within `bounds`."""
    me = len(nodes)
    g, h = gradient[rows], weight[rows]
    value = float(np.clip(_step(g.sum(), h.sum()), *bounds))
    nodes.append([0, 0.0, me, me, value])
    best = _best_split(binned[rows], signs, g, h) if depth < DEPTH else None
    if best is None:
        score[rows] += value
        return me
    feature, at, left_value, right_value = best
    goes_left = binned[rows, feature] <= at
    low, high = bounds
    if signs[feature]:
        middle = float(np.clip((left_value + right_value) / 2, low, high))
        left_bounds, right_bounds = (middle, high), (low, middle)
    else:
        left_bounds = right_bounds = bounds
    rest = (binned, cuts, signs, gradient, weight, score)
    left = _grow(nodes, rows[goes_left], depth + 1, left_bounds, *rest)
    right = _grow(nodes, rows[~goes_left], depth + 1, right_bounds, *rest)
    nodes[me] = [feature, float(cuts[feature][at]), left, right, 0.0]
    return me


def _best_split(binned, signs, g, h):
    best, best_gain = None, 1e-6
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(binned.shape[1]):
        column = binned[:, f]
        size = int(column.max()) + 1
        if size < 2:
            continue
        n = np.cumsum(np.bincount(column, minlength=size))[:-1]
        lg = np.cumsum(np.bincount(column, g, size))[:-1]
        lh = np.cumsum(np.bincount(column, h, size))[:-1]
        rg, rh = g.sum() - lg, h.sum() - lh
        gain = lg**2 / (lh + 1.0) + rg**2 / (rh + 1.0) - whole
        allowed = (n >= LEAF) & (len(column) - n >= LEAF)
        if signs[f]:
            allowed &= _step(lg, lh) >= _step(rg, rh)
        gain = np.where(allowed, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > best_gain:
            best_gain = gain[at]
            best = (f, at, float(_step(lg[at], lh[at])), float(_step(rg[at], rh[at])))
    return best


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `sample` labelled documents, chosen by a hash of the id.

    Labels without id or quality are left out; of several for an id, the lowest quality holds, and
    of several documents with an id, one.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("good"))
        .where("id is not null and good is not null")
        .groupBy("id")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    # `sample` bounds the broadcast side.
    texts = (
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(F.broadcast(chosen), "id")
        .dropDuplicates(["id"])
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            _, x = statistics(Texts.of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2)],
                names=["id", "x", "good"],
            )

    kind = T.StructType(
        [
            T.StructField("id", texts.schema["id"].dataType),
            T.StructField("x", T.ArrayType(T.DoubleType())),
            T.StructField("good", T.IntegerType()),
        ]
    )
    rows = texts.mapInArrow(run, kind).collect()
    rows.sort(key=lambda r: r["id"])
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return x, np.array([int(r["good"] > 0) for r in rows])


def fit_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    return fit(*training_rows(docs, labels, sample))


def judge(docs: DataFrame, model: Trees, prefix: str = "") -> DataFrame:
    """Every row of `docs` with the base counts, base_failed, score and kept, named with `prefix`."""
    fields = T.StructType(
        [T.StructField(c, T.LongType()) for c in BASE]
        + [
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def compute(batch):
        counts, x = statistics(Texts.of(batch.column("text")))
        failed, score = base_failed(counts), model.score(x)
        return [*counts.T, failed, score, ~failed & (score >= 0)]

    return append_columns(docs, fields, compute, prefix)


def quality_report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: base counts, base_failed, score, kept."""
    return judge(docs.select("doc_id", "text"), fit_model(docs, labels, sample)).drop("text")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that are kept, with their columns."""
    prefix = free_prefix(docs)
    judged = judge(docs, fit_model(docs, labels, sample), prefix)
    return judged.where(F.col(f"{prefix}kept")).select(*columns_of(docs))
