import hashlib
import random
import re

import awkward

from alertloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    doc = words(text)
    hit, found = set(), set()
    for item, body in items:
        w = words(body)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            window = w[i : i + size]
            for at in range(len(doc) - size + 1):
                if doc[at : at + size] == window:
                    hit.update(range(at, at + size))
                    found.add(str(item) if item is not None else "")
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    n = len(hit)
    return len(doc), n, len(found), digest, n > 0 and 20 * n >= len(doc)


def items(seed):
    r = random.Random(seed)
    out = [(i, " ".join(r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(r.choice([3, 13, 14, 20, 40])))) for i in range(12)]
    return out + [(20, out[3][1]), (21, out[4][1] + " more words"), (100, None), (101, ""), (102, "ab"), (None, "w1 w2"), (103, "É zürich"), (3, "w3 w4 w5 w6 w7")]


def documents(seed, bench):
    r = random.Random(seed + 50)
    out = awkward.texts(seed, 80)
    for _ in range(80):
        own = [f"z{r.randrange(50)}" for _ in range(r.choice([0, 5, 40, 500]))]
        body = words(r.choice(bench)[1])
        low = r.randrange(len(body) + 1)
        at = r.randrange(len(own) + 1)
        sep = r.choice([" ", ", ", "\n", "--"])
        out.append(sep.join([*own[:at], *[x.upper() if r.random() < 0.2 else x for x in body[low:]], *own[at:]]))
    return out


def check(spark, seed, **kw):
    bench = items(seed)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(documents(seed, bench))]
    table = spark.createDataFrame([(*b, "extra") for b in bench], "item_id long, text string, doc_id string")
    found = decontaminate.contamination(awkward.frame(spark, rows, clashing=False), table, **kw).collect()
    assert len(found) == len(rows)
    some = 0
    for r in found:
        expected = brute(rows[r["doc_id"]][1], bench)
        some += expected[4]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == expected
    assert some > 10


def test_matches_brute_force(spark):
    check(spark, 1)


def test_blocks_of_windows_match_too(spark):
    check(spark, 2, block=40)


def test_documents_stay_whole(spark):
    bench = items(1)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(documents(1, bench))]
    table = spark.createDataFrame(bench, "item_id long, text string")
    docs = awkward.frame(spark, rows, clashing=True)
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    clean = [r[0] for r in rows if not brute(r[1], bench)[4]]
    assert sorted(r["doc_id"] for r in kept.collect()) == clean


def test_empty_tables(spark):
    docs = awkward.frame(spark, awkward.rows(1, 20))
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(awkward.frame(spark, []), none).count() == 0


def test_prefix_token_is_the_rarest():
    import numpy as np

    w = np.arange(1, 14, dtype=np.uint64)
    block = decontaminate.Windows.of([("a", w)])
    grams = block.shingles()[4].tolist()
    rare = grams[5]
    index = decontaminate.Index.of(block, {(4, g): 1 + (g != rare) for g in grams})
    assert index.tokens[4].tolist() == [rare]


def test_the_benchmark_stays_in_spark(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("the benchmark goes through the driver")

    for name in ("toLocalIterator", "toPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, refused)
    check(spark, 3)


def test_a_full_filter_loses_no_match(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 6)
    check(spark, 4)
