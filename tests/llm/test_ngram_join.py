import random
import re
from itertools import combinations

import awkward
import pytest

from alertloom.llm import graph, ngram_join

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= 4:
        return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))
    return frozenset([tuple(words)] if words else [])


def link(a, b):
    return bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)


def brute(rows):
    """By position in `rows`: set size and the positions of its group."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if link(sets[i], sets[j]):
            a, b = find(i), find(j)
            group[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    return sets, [members[find(i)] for i in range(len(rows))]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = awkward.rows(seed, 160)
    sets, groups = brute(rows)
    found = ngram_join.jaccard_components(awkward.frame(spark, rows, clashing=True)).collect()
    assert len(found) == len(rows)
    for r in found:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"]) == (len(sets[i]), min(groups[i])), rows[i]
    # One row of each group stands for it; rows without shingles all stay.
    assert sum(r["is_kept"] for r in found) == len({tuple(g) for g in groups})


def test_chains_of_near_copies_are_one_group(spark):
    r = random.Random(5)
    words = [f"v{r.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words), "en", "s", 0))
        words[(7 * i) % 150] = f"n{i}"
    sets, groups = brute(rows)
    assert any(len(g) > 20 for g in groups)
    found = {x["doc_id"]: x["component_id"] for x in ngram_join.jaccard_components(awkward.frame(spark, rows)).collect()}
    assert found == {i: min(g) for i, g in enumerate(groups)}


def test_all_links(spark):
    r = random.Random(3)
    rows = awkward.rows(3, 120)
    for i in range(120, 150):
        near = rows[r.randrange(100, i)][1].split(" ")
        near = near if len(near) > 60 else [f"t{j}" for j in range(80)]
        near[r.randrange(len(near))] = f"new{i}"
        rows.append((i, " ".join(near), "en", "s", 0))
    sets = [shingles(r[1]) for r in rows]
    links, members = ngram_join.jaccard_links(awkward.frame(spark, rows))
    of = {}
    for m in members.collect():
        of.setdefault(m["node"], []).append(m["doc_id"])
    found = {frozenset((min(of[x["a"]]), min(of[x["b"]]))) for x in links.collect()}
    first = {}
    for i, s in enumerate(sets):
        if s:
            first.setdefault(s, i)
    expected = {frozenset((first[a], first[b])) for a, b in combinations(first, 2) if link(a, b)}
    assert found == expected and expected


def test_large_lists_are_dealt_whole(spark):
    lists = {-1: 4000, **{t: 2 + t % 5 for t in range(1000)}, **{t: 1 for t in range(1000, 1500)}}
    rows = [(t * 10_000 + i if t >= 0 else i, 9, 0, t) for t, n in lists.items() for i in range(n)]
    entries = spark.createDataFrame(rows, "node long, n long, pos int, token long")
    dealt = ngram_join._dealt(entries, 64).collect()
    assert sorted((r["node"], r["token"]) for r in dealt) == sorted((r[0], r[3]) for r in rows if lists[r[3]] > 1)
    piece = -(-len(dealt) // 64)
    parts = {}
    for r in dealt:
        assert r["salts"] == -(-lists[r["token"]] // piece) and 0 <= r["salt"] < r["salts"]
        parts[r["token"], r["salt"]] = parts.get((r["token"], r["salt"]), 0) + 1
    assert max(parts.values()) < 2 * piece < 400


def test_null_and_repeated_ids(spark):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(None, text, "en", "s", 1), (7, text, "en", "s", 1), (7, text, "en", "s", 1), (None, "other words here now", "en", "s", 1)]
    found = ngram_join.jaccard_components(awkward.frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in found if r["n_shingles"] == 3) == [(False, 7), (False, 7), (True, 7)]
    assert [r["component_id"] for r in found if r["n_shingles"] == 1] == [None]
    kept = ngram_join.drop_near_copies(awkward.frame(spark, rows)).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 7]


def test_empty_table(spark):
    empty = awkward.frame(spark, [])
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.drop_near_copies(empty).columns == empty.columns


def test_sizes_match_the_threshold():
    for n in range(1, 40):
        for m in range(n, 40):
            need = ngram_join.required(n, m)
            assert 100 * need >= 85 * (n + m - need) and 100 * (need - 1) < 85 * (n + m - need + 1)
        assert ngram_join.listed(n) == n - min(o for o in range(n + 1) if 100 * o >= 85 * n) + 1


def test_boundary_grows_with_small_sets():
    few, many = [0] * 33, [0] * 33
    many[5:12] = [1000] * 7
    few[32] = 1000
    assert ngram_join.boundary(__import__("numpy").array(many)) > 5
    assert ngram_join.boundary(__import__("numpy").array(few)) < 32


def test_components_of_random_graphs(spark):
    r = random.Random(9)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(70)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in linked}
