import hashlib
import random
from collections import Counter, defaultdict

import awkward
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from alertloom.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path(alignment.A))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B))
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelt_a(i):
    text = A.id_to_token(i)
    visible = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    hidden = [b for b in range(256) if b not in visible]
    if text == "<|endoftext|>":
        return text.encode()
    return bytes(ord(c) if ord(c) < 256 else hidden[ord(c) - 256] for c in text)


def spelt_b(i):
    piece = B.id_to_piece(i)
    if B.is_byte(i):
        return bytes([int(piece[1:-1], 16)])
    return piece.replace("▁", " ").encode()


def tokens(ids, spelt):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(spelt(i))))
        at = out[-1][2]
    return out


def aligned(text):
    """Groups and links of one text, by comparing all tokens' byte ranges."""
    if not text:
        return [], []
    a = tokens(A.encode(" " + text, add_special_tokens=False).ids, spelt_a)
    b = tokens(B.encode(text), spelt_b)
    data = (" " + text).encode()
    if b"".join(spelt_a(i) for i, _, _ in a) != data or b"".join(spelt_b(i) for i, _, _ in b) != data:
        return [], []
    cuts = sorted({y for _, _, y in a} & {y for _, _, y in b})
    groups = []
    upto = [{y: n + 1 for n, (_, _, y) in enumerate(t)} | {0: 0} for t in (a, b)]
    for low, high in zip([0, *cuts], cuts):
        groups.append(tuple(tuple(i for i, _, _ in t[u[low] : u[high]]) for t, u in zip((a, b), upto)))
    by_place = [[] for _ in data]
    for i, x, y in b:
        for at in range(x, y):
            by_place[at].append((i, x))
    links = [(i, j) for i, x, y in a for j, _ in sorted({m for at in range(x, y) for m in by_place[at]})]
    return groups, links


def brute(texts):
    found = [aligned(t) for t in texts]
    counts = Counter(p for _, links in found for p in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for groups, links in found:
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(told.encode()).hexdigest() if told else "",
        ))
    return out


HARD = [
    None, "", " ", "  ", "\n", "\n\n x", "x \n", "a  b   c    d", " lead", "trail ", "tab\tx\t\ty \t z", "a\r\nb\r\n", "a {\r\n}\r\n",
    "don't we'll I'm 'tis x's y'S", "▁", "a▁b", "a ▁ b", "<|endoftext|>", "x<|endoftext|>y <s> </s> <unk> <0x41>", "ﬁ ① Å",
    "日本語のテキスト です。", "emoji 😀👩‍👩‍👧 done", "a\x00b", "﻿bom", "a b   c　d", "\x1c\x1d x\x1f y", "é é", "aaaa" * 40,
    "no" * 3000, "0123456789" * 9 + " 3.14 1,000", "#*$%&|<>~^`", "  x y \x85 z", "ÄÖÜ ß straße", "퟿  \U0010ffff",
]


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 0])
def test_results_equal_plain_alignment(spark, most_sent):
    r = random.Random(5)
    texts = HARD + awkward.texts(4, 80) + ["same words here"] * 4
    letters = "ab \n\t'.é日▁😀<|0x{}\r"
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(1, 40))) for _ in range(120)]
    docs = awkward.frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)], clashing=True)
    got = alignment.align_documents(docs, most_sent=most_sent).collect()
    assert len(got) == len(texts)
    expected = brute(texts)
    assert {r["doc_id"]: tuple(r[c] for c in NAMES) for r in got} == dict(enumerate(expected))
    assert sum(e[3] == 0 for e in expected) < len(texts) / 2


def test_words_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in alignment.align_documents(docs).collect()}
    assert got == {r["doc_id"]: e for r, e in zip(rows, brute([r["text"] for r in rows]))}


def test_exact_pairs_need_no_list_of_their_own():
    one = alignment.aligner(*alignment._paths(None, None))
    known = [i for i, x in enumerate(one.same) if x >= 0]
    assert len(known) > 10_000 and all(spelt_a(i) == spelt_b(int(one.same[i])) for i in known)
    # A byte that has a piece of its own is that piece, not the fallback.
    assert not B.is_byte(int(one.same[A.token_to_id("a")]))


def test_what_is_kept_of_chunks_is_bounded(monkeypatch):
    one = alignment.Aligner(*alignment._paths(None, None))
    monkeypatch.setattr(alignment, "_MOST_CACHED", 50)
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(20)]
    whole = [aligned(t) for t in texts]
    for text, (groups, links) in zip(texts, whole):
        rows, found, offsets, _ = one.read([text])
        assert (rows[0][2], rows[0][3]) == (len(groups), len(links)) and sorted(found) == sorted(a << alignment.B_BITS | b for a, b in links)
        assert len(one.texts) <= 50 + 31


def test_pair_counts_are_of_documents(spark):
    docs = awkward.frame(spark, [(1, "go go go", "en", "s", 0), (1, "go", "en", "s", 0), (2, "stop", "en", "s", 0)])
    got = {r["pair"]: r["docs"] for r in alignment.pair_counts(docs).collect()}
    expected = Counter(p for t in ("go go go", "go", "stop") for p in set(aligned(t)[1]))
    assert got == {a << alignment.B_BITS | b: n for (a, b), n in expected.items()}


def test_no_rows(spark):
    docs = awkward.frame(spark, [(1, "x", "en", "s", 0)]).where("false")
    for most in (alignment.MOST_SENT, -1):
        got = alignment.align_documents(docs, most_sent=most)
        assert got.columns == ["doc_id", *NAMES] and got.count() == 0
    nulls = awkward.frame(spark, [(None, None, None, None, None)] * 2)
    assert [tuple(r) for r in alignment.align_documents(nulls).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")] * 2
