import random
import zlib

import awkward
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from alertloom.llm import packing, tokens
from alertloom.llm.text import Texts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.vocabulary_path())


def ids_of(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_match_the_library(library):
    r = random.Random(3)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ve", "'ll", "'x", "1", "22", "!", "?!", "ß", "²", "½", "ª"]
    parts += ["'t", "'D", "'m", "'d", "<|endoftext|>", "漢", "🙂", "\x1c", "\x85", "\xa0", "\x00", "\r", "don't", " I'll"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(5000)]
    texts += ["", "x" * 9000, "word " * 3000, *[t or "" for t in awkward.texts(1)]]
    flat, at = tokens.Tokenizer(tokens.vocabulary_path()).encode(Texts.of(pa.array(texts)), 7)
    for i, t in enumerate(texts):
        assert flat[at[i] : at[i + 1]].tolist() == ids_of(library, t, 7), repr(t)


def test_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "_MOST_CACHED", 50)
    mine = tokens.Tokenizer(tokens.vocabulary_path())
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(20)]
    for t in texts:
        flat, _ = mine.encode(Texts.of(pa.array([t])), 7)
        assert flat.tolist() == ids_of(library, t, 7)


def plain_best_fit(sizes, capacity, most_open):
    """The same rule with a list of open bins."""
    free, made = {}, 0
    for size in sizes:
        fitting = [(f, b) for b, f in free.items() if f >= size]
        if fitting:
            left = min(f for f, _ in fitting)
            yield left, None
            number = [b for f, b in fitting if f == left][-1]
        else:
            number, left, made = made, capacity, made + 1
            yield left, None
        free.pop(number, None)
        if left - size:
            free[number] = left - size
        if len(free) > most_open:
            free.pop(min(free, key=lambda b: (free[b], -list(free).index(b))))


@pytest.mark.parametrize("most_open", [1, 4, 30])
def test_best_fit_follows_the_rule(most_open):
    r = random.Random(most_open)
    sizes = [r.randrange(1, 101) for _ in range(3000)]
    spaces = [100 - offset for _, offset in packing.pack_sizes(sizes, 100, most_open)]
    assert spaces == [f for f, _ in plain_best_fit(sizes, 100, most_open)]


def test_full_bins_close_and_sizes_fit():
    fit = packing.BestFit(10, 2)
    assert [fit.place(s) for s in (10, 6, 4, 5, 5)] == [(0, 0), (1, 0), (1, 6), (2, 0), (2, 5)]
    fill = {}
    r = random.Random(1)
    for s, (b, offset) in zip(sizes := [r.randrange(1, 1025) for _ in range(5000)], packing.pack_sizes(sizes)):
        assert fill.get(b, 0) == offset and offset + s <= 1024
        fill[b] = offset + s
    assert sum(sizes) / (1024 * len(fill)) > 0.93


def blocks_of(sizes, block=packing.BLOCK):
    """The sizes in the order of arrival: in blocks, in each of them longest first."""
    return [x for i in range(0, len(sizes), block) for x in sorted(sizes[i : i + block], reverse=True)]


def test_blocks_fill_nearly_all_with_the_bound_at_work():
    r = random.Random(2)
    sizes = [r.randrange(1, 1024) for _ in range(packing.LANE)]
    bins = 1 + max(b for b, _ in packing.pack_sizes(blocks_of(sizes)))
    assert sum(sizes) / (1024 * bins) > 0.98


def test_the_bound_closes_bins_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    cut_up = packing.stored(packing.pieces(docs, tokens.vocabulary_path()))
    short = cut_up.where("length < 1024")
    dealt = packing.arrivals(short, short.count())
    sizes = [r[0] for r in dealt.orderBy("lane", "block", packing.F.desc("length"), "mixed").select("length").collect()]
    fit, free = packing.BestFit(), packing.BestFit(most_open=len(sizes))
    for s in sizes:
        fit.place(s)
        free.place(s)
    lower = -(-sum(sizes) // 1024)
    assert fit.closed > 0 and free.closed == 0
    assert fit.made <= 1.005 * lower and fit.made <= 1.002 * free.made, (fit.made, free.made, lower, fit.closed)
    found = packing.pack_pieces(cut_up)
    assert found.select("sequence_id").distinct().count() == fit.made + cut_up.where("length = 1024").count()


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(1024) == [(0, 1024)]
    assert packing.cut(2500) == [(0, 452), (452, 1024), (1476, 1024)]


def check(rows, found, library, capacity):
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for number, text in rows:
        ids = ids_of(library, text, 2)
        mine = sorted(by_doc.pop(number), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["length"] for r in mine] == [n for _, n in packing.cut(len(ids), capacity)]
        for r in mine:
            assert r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
    assert not by_doc
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pieces_cover_documents_and_fill_sequences(spark, library, capacity):
    rows = awkward.rows(4)
    found = packing.pack_documents(awkward.frame(spark, rows, clashing=True), capacity=capacity).collect()
    check([(r[0], r[1]) for r in rows], found, library, capacity)


def test_many_lanes(spark, library):
    rows = awkward.rows(4)
    cut_up = packing.stored(packing.pieces(awkward.frame(spark, rows), tokens.vocabulary_path(), 64))
    check([(r[0], r[1]) for r in rows], packing.pack_pieces(cut_up, 64, 3, lane=7, block=2).collect(), library, 64)


def test_ids_come_along(spark, library):
    rows = awkward.rows(4, 30)
    found = packing.pack_documents(awkward.frame(spark, rows), capacity=64, ids=True).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        assert r["ids"] == ids_of(library, texts[r["doc_id"]], 2)[r["start"] : r["start"] + r["length"]]


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "same text", "en", "s", 1)] * 3 + [(None, None, None, None, None)]
    found = packing.pack_documents(awkward.frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in found) == [(0, 1), (5, 3), (5, 3), (5, 3)]
    assert len({r["sequence_id"] for r in found}) == 1
    assert packing.pack_documents(awkward.frame(spark, [])).count() == 0
