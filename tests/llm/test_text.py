import random
import re

import numpy as np
import pyarrow as pa
import pytest

from alertloom.llm.text import NOT_ALNUM, SPACE, Texts, Words

PATTERNS = {
    "space": (SPACE, False, r"[^\x20\x09-\x0D]+"),
    "alnum": (NOT_ALNUM, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
}
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def texts():
    r = random.Random(6)
    out = [None, "", " ", "a", " a", "a ", "A\x00b", "é", "x" * 5000, "x" * 5001 + " y", "x" * 4999 + "yx", "\x1c\x85\xa0"]
    for _ in range(400):
        out.append("".join(r.choice("abAZ09 \n\t\x0b.-é漢🙂\x00\x1f") for _ in range(r.randrange(30))))
    return out


@pytest.mark.parametrize("kind", sorted(PATTERNS))
def test_words_and_grams_have_equal_hashes_exactly_if_equal(kind):
    table, lower, pattern = PATTERNS[kind]
    given = texts()
    column = pa.array(["skipped", *given], pa.string()).slice(1)
    words = Words(Texts.of(column), table, lower)
    expected = [re.findall(pattern, (t or "").translate(LOWER) if lower else t or "") for t in given]
    assert words.counts().tolist() == [len(w) for w in expected]
    for k in (1, 2, 3, 4):
        hashes = words.hashes if k == 1 else words.grams(k)
        of, back = {}, {}
        for i, w in enumerate(expected):
            for j in range(len(w) - k + 1):
                gram, h = tuple(w[j : j + k]), int(hashes[words.first[i] + j])
                assert of.setdefault(gram, h) == h and back.setdefault(h, gram) == gram
        assert len(of) > 100


def test_hashes_do_not_depend_on_neighbours_or_slices():
    given = texts()
    whole = Words(Texts.of(pa.array(given)), SPACE)
    for low, high, part in Texts.of(pa.array(given)).slices(64):
        mine = Words(part, SPACE)
        assert (mine.hashes == whole.hashes[whole.first[low] : whole.first[high]]).all()


def test_whole_sequence_equals_the_gram_of_its_length():
    words = Words(Texts.of(pa.array(["a b c", "x", "b c"])), SPACE)
    assert words.whole(0) == words.grams(3)[0]
    assert words.whole(2) == words.grams(2)[words.first[2]]
    assert words.whole(1) == words.grams(1)[words.first[1]]


def test_slices_cover_all_texts_in_order():
    t = Texts.of(pa.array(["ab", "", "c" * 50, "", "d", "e"]))
    spans = [(a, b) for a, b, _ in t.slices(3)]
    assert spans[0][0] == 0 and spans[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert np.concatenate([p.data for _, _, p in t.slices(3)]).tobytes() == b"ab" + b"c" * 50 + b"de"
