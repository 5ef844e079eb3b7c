"""Alignment of the tokens of two tokenizers over the same bytes, and how often their ids are linked.

Both tokenizers cut the bytes of a space and the text. Offsets where tokens of both end cut them into groups; two
tokens are linked where their bytes overlap. Most groups are one token of A and the token of B with the same bytes:
an array over A's vocabulary names that token, so such a link is an index into a vector as long as A's
vocabulary, and documents are counted in that vector. All other links are counted as pairs of ids, summed in the task
and then by a shuffle.

Texts are cut into chunks where neither tokenizer can have a token that goes on: before a space or line end, and between
letters and marks if B has no entry of both. A splits there by its pattern; B's entries are looked through.
A chunk is aligned by itself, and each distinct chunk once; a document's numbers are sums over its chunks. What a task
keeps of chunks is bounded.

The second pass looks counts up. Up to a stated number of pairs they are sent to all tasks as two arrays of whole
numbers; beyond it each document's pairs are joined with them by a shuffle. Both give the same rows.

Defined cases: a null or empty text has no tokens, and neither has one that the tokens do not spell: the second
tokenizer takes U+2581 for a space. Strings of special tokens are plain text. A pair that is linked several times in a
document counts it once, also if some of its links are in groups of several tokens. Repeated rows count each. An empty
table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.session import stored

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Pairs of ids, at 16 bytes each, that are sent to all tasks at most.
MOST_SENT = 1 << 21
# A process forgets its chunks at this number of them or of their characters; longer ones are not looked up again.
_MOST_CACHED, _MOST_CHARACTERS, _LONGEST_CACHED = 1_000_000, 12_000_000, 64
# Pairs wait in a task to be summed up to this number.
_MOST_WAITING = 1 << 21
# A chunk ends before a space or line end after something else; finer ones also where Latin letters and ASCII marks or
# digits meet, except after an apostrophe, which can begin an ending.
_LETTER, _SIGN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F", "!-@\\[-`{-~"
_COARSE = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
_FINE = re.compile(
    rf"\s*+(?:[{_LETTER}]++(?![^{_SIGN} \n])|[{_SIGN}]++(?:(?![^ \n])|(?<!')(?=[{_LETTER}])))"
    rf"|\s*+\S(?:(?!(?<=\S)[ \n]|(?<=[{_LETTER}])[{_SIGN}]|(?<![^{_SIGN}])(?<!')[{_LETTER}]).)*|\s++",
    re.DOTALL,
)
# Bits of B's ids in a pair, and of a pair.
B_BITS, _BITS = 20, 41
_MARK = "▁"


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Both tokenizers, the bytes of their entries, and the chunks aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_values()
        vocabulary = self.a.get_vocab()
        self.bytes_a: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            if all(c in byte_of for c in entry):
                self.bytes_a[i] = bytes(byte_of[c] for c in entry)
            else:
                self.bytes_a[i] = entry.encode()
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.get_piece_size())]
        first: dict[bytes, int] = {}
        for i, x in enumerate(self.bytes_b):
            # A byte has an entry for itself, which comes before the piece of one character that has the same byte.
            if x and (x not in first or self.b.is_byte(first[x])):
                first[x] = i
        self.same = np.array([first.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        if len(self.bytes_a) >= 1 << (_BITS - B_BITS) or len(self.bytes_b) >= 1 << B_BITS:
            raise ValueError("a vocabulary has too many entries")
        inner = [x.decode(errors="ignore").lstrip(" ") for x in self.bytes_b]
        if any(" " in x or "\n" in x[1:] for x in inner):
            raise ValueError("the second vocabulary has an entry that goes on after a space or line end")
        is_mixed = any(x[:-1].isalpha() != x[1:].isalpha() or x.isalpha() != x[:1].isalpha() for x in inner if len(x) > 1)
        self.chunk = _COARSE if is_mixed else _FINE
        self.length_a, self.length_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        self._clear()

    def _bytes_b(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_MARK, " ").encode()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.characters = 0
        # Per chunk: whether it is spelt, tokens of A and B, groups, links, and where its links begin; its groups as text.
        self.facts = np.zeros((1 << 12, 6), np.int64)
        self.links = np.zeros(1 << 16, np.int64)
        self.texts: list[str] = []
        self.size = 0

    def _align(self, chunks: list[str]) -> dict[str, int]:
        """Align new chunks; the number of each. Cuts lie between chunks, so all are aligned as one run of bytes."""
        ids_a = [x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        # The line end keeps the space that B puts before a text apart from the chunk.
        ids_b = [x[2:] for x in self.b.encode(["\n" + c for c in chunks], num_threads=1)]
        data = [c.encode() for c in chunks]
        spelt = np.ones(len(chunks), bool)
        if not self._spell(ids_a, self.bytes_a) == b"".join(data) == self._spell(ids_b, self.bytes_b):
            for i, d in enumerate(data):
                spelt[i] = self._spell(ids_a[i : i + 1], self.bytes_a) == d == self._spell(ids_b[i : i + 1], self.bytes_b)
                if not spelt[i]:
                    ids_a[i], ids_b[i], data[i] = [], [], b""
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # Tokens of A from the one in which a token of B begins to the one in which it ends.
        low = np.searchsorted(ends_a, ends_b - self.length_b[b], side="right")
        each = np.searchsorted(ends_a, ends_b) - low + 1
        of_a = np.repeat(low - np.cumsum(each) + each, each) + np.arange(each.sum())
        links = a[of_a] << B_BITS | np.repeat(b, each)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        groups, i, j = [], 0, 0
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        for x, y in zip((np.searchsorted(ends_a, cuts) + 1).tolist(), (np.searchsorted(ends_b, cuts) + 1).tolist()):
            if x == i + 1 and y == j + 1:
                groups.append(f"{names_a[i]}|{names_b[j]}")
            else:
                groups.append(",".join(names_a[i:x]) + "|" + ",".join(names_b[j:y]))
            i, j = x, y
        # The chunks' shares of all this, by their places.
        upto = np.cumsum([0, *map(len, data)])
        of_group = np.searchsorted(cuts, upto, side="right")
        of_b = np.searchsorted(ends_b, upto, side="right")
        of_link = np.concatenate([[0], np.cumsum(each)])[of_b]
        facts = [spelt, np.diff(np.searchsorted(ends_a, upto, side="right")), np.diff(of_b), np.diff(of_group), np.diff(of_link)]
        first = self._keep(np.stack([*facts, self.size + of_link[:-1]], axis=1), links)
        self.texts += [";".join(groups[x:y]) for x, y in zip(of_group.tolist(), of_group[1:].tolist())]
        self.characters += sum(map(len, chunks))
        made = dict(zip(chunks, range(first, first + len(chunks))))
        self.numbers.update((c, n) for c, n in made.items() if len(c) <= _LONGEST_CACHED)
        return made

    @staticmethod
    def _spell(ids: list[list[int]], entries: list[bytes]) -> bytes:
        return b"".join([entries[i] for x in ids for i in x])

    def _keep(self, facts: np.ndarray, links: np.ndarray) -> int:
        number = len(self.texts)
        while number + len(facts) > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        while self.size + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.facts[number : number + len(facts)] = facts
        self.links[self.size : self.size + len(links)] = links
        self.size += len(links)
        return number

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Per text the number of tokens of A and B, groups and links; all links and the offsets of the texts; the groups."""
        if len(self.texts) > _MOST_CACHED or self.characters > _MOST_CHARACTERS:
            self._clear()
        chunks = [self.chunk.findall(" " + text) if text else [] for text in texts]
        known = self.numbers.get
        every = [c for x in chunks for c in x]
        numbers = list(map(known, every))
        new = list({c for c, n in zip(every, numbers) if n is None})
        if new:
            made = self._align(new)
            numbers = [made[c] if n is None else n for c, n in zip(every, numbers)]
        ends = np.cumsum([0, *map(len, chunks)])
        numbers = np.array(numbers, np.int64)
        # A text with a chunk that is not spelt has no tokens.
        odd = np.diff(np.concatenate([[0], np.cumsum(self.facts[numbers, 0] == 0)])[ends]) > 0
        if odd.any():
            numbers = numbers[~np.repeat(odd, np.diff(ends))]
            ends = np.cumsum([0, *np.where(odd, 0, np.diff(ends))])
        facts = self.facts[numbers]
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(facts[:, 1:5], axis=0)])[ends]
        lengths = facts[:, 4]
        take = np.arange(lengths.sum()) + np.repeat(facts[:, 5] - np.cumsum(lengths) + lengths, lengths)
        told = [self.texts[n] for n in numbers.tolist()]
        spans = zip(ends.tolist(), ends[1:].tolist())
        names = [hashlib.sha256(";".join(told[x:y]).encode()).hexdigest() if x < y else "" for x, y in spans]
        return np.diff(sums, axis=0), self.links[take], sums[:, 3], names


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The process's aligner, which keeps its chunks from task to task."""
    return Aligner(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(A), path_b or public_tokenizers.path(B)


def _distinct(links: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, the link and the number of occurrences of every link of every text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys, n = np.unique(text << _BITS | links, return_counts=True)
    return keys >> _BITS, keys & ((1 << _BITS) - 1), n


def _slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive runs of texts of about `limit` characters."""
    low, size, run = 0, 0, []
    for i, text in enumerate(column.to_pylist()):
        run.append(text)
        size += len(text or "")
        if size >= limit:
            yield low, run
            low, size, run = i + 1, 0, []
    if run:
        yield low, run


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(pair, docs) for every pair of ids linked anywhere; a pair is A's id, and B's in the lower 20 bits."""
    paths = _paths(path_a, path_b)

    def batch_of(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(counts, pa.int64())], names=["pair", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = aligner(*paths).same
        exact = np.zeros(len(same), np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def summed() -> pa.RecordBatch:
            return batch_of(*np.unique(np.concatenate([np.zeros(0, np.int64), *waiting]), return_counts=True))

        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                _, links, offsets, _ = aligner(*paths).read(texts)
                _, pairs, _ = _distinct(links, offsets)
                is_exact = same[pairs >> B_BITS] == (pairs & ((1 << B_BITS) - 1))
                exact += np.bincount(pairs[is_exact] >> B_BITS, minlength=len(exact))
                waiting.append(pairs[~is_exact])
                size += len(waiting[-1])
                if size > _MOST_WAITING:
                    yield summed()
                    waiting, size = [], 0
        yield summed()
        seen = np.flatnonzero(exact)
        yield batch_of(seen << B_BITS | same[seen], exact[seen])

    made = docs.select("text").mapInArrow(run, "pair long, docs long")
    return made.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _sums(text: np.ndarray, n: np.ndarray, count: np.ndarray, best: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: links that are the best of their A id, and the sum of all links' counts."""
    most, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(most, text, n * (count == best))
    np.add.at(total, text, n * count)
    return most, total


def _report_by_arrays(docs: DataFrame, paths: tuple[str, str], pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((pairs, counts, best))
    key = docs.schema["doc_id"]
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    kinds = T.StructType([key, *(T.StructField(c, T.LongType()) for c in numbers), T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = sent.value
        for batch in batches:
            for low, texts in _slices(batch.column(1)):
                rows, links, offsets, names = aligner(*paths).read(texts)
                text, found, n = _distinct(links, offsets)
                at = np.searchsorted(pairs, found)
                if not np.array_equal(pairs[np.minimum(at, len(pairs) - 1)], found):
                    raise ValueError("the documents are not those that were counted")
                count = counts[at]
                sums = _sums(text, n, count, best[found >> B_BITS], len(texts))
                columns = [pa.array(c) for c in (*rows.T, *sums)]
                ids = batch.column(0).slice(low, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *columns, pa.array(names, pa.string())], names=kinds.names)

    return docs.select("doc_id", "text").mapInArrow(run, kinds)


def _report_by_join(docs: DataFrame, paths: tuple[str, str], counts: DataFrame, best: DataFrame) -> DataFrame:
    """Each document's pairs meet their counts by a shuffle; a pair of very many documents is split by a salt."""
    salts = 16
    key = docs.schema["doc_id"]
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    kinds = T.StructType(
        [key, *(T.StructField(c, T.LongType()) for c in numbers), T.StructField("groups_sha256", T.StringType())]
        + [T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in _slices(batch.column(1)):
                rows, links, offsets, names = aligner(*paths).read(texts)
                text, found, n = _distinct(links, offsets)
                at = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x, pa.int64())) for x in (found, n)]
                columns = [*(pa.array(c) for c in rows.T), pa.array(names, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(texts)), *columns], names=kinds.names)

    # Written once: the numbers of the rows must be the same when the sums come back.
    rows = stored(docs.select("doc_id", "text").mapInArrow(run, kinds).withColumn("row", F.monotonically_increasing_id()))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt")
    links = rows.select("row", salt, F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    links = links.select("row", "salt", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    known = counts.withColumn("a", F.shiftright("pair", B_BITS)).join(best, "a").drop("a")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = links.join(known, ["pair", "salt"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("docs") == F.col("most"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("docs")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    joined = rows.drop("pairs", "times").join(sums, "row", "left").drop("row")
    return joined.withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})


def align_documents(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_sent: int = MOST_SENT
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = _paths(path_a, path_b)
    counts = stored(pair_counts(docs, *paths))
    # At most one row for each entry of A's vocabulary.
    best = counts.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("docs").alias("most"))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() > most_sent:
        return _report_by_join(docs, paths, counts, best).select(columns)
    table = counts.toArrow()
    pairs, n = (table.column(c).to_numpy() for c in ("pair", "docs"))
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    highest = np.zeros(int(pairs[-1] >> B_BITS) + 1 if len(pairs) else 1, np.int64)
    np.maximum.at(highest, pairs >> B_BITS, n)
    return _report_by_arrays(docs, paths, pairs, n, highest).select(columns)
