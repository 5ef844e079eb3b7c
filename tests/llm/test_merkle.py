import hashlib
import random
import zlib

import awkward
import pytest
from compare import connect, differences, spark_rows, sql_rows

from alertloom.llm import merkle, oracle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes, run=3):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i : i + run]) for i in range(0, len(last), run)])
    return out


def path(levels, number, run=3):
    """Per level: the siblings before and after."""
    out = []
    for nodes in levels[:-1]:
        first = number - number % run
        out.append((nodes[first:number], nodes[number + 1 : first + run]))
        number //= run
    return out


def climb(node, steps):
    for before, after in steps:
        node = h(*before, node, *after)
    return node


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        members = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = (members, levels_of([leaf(r, r[1]) for r in members]))
    tops = levels_of([trees[s][1][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        members, levels = trees[source]
        for number, row in enumerate(members):
            steps = path(levels, number) + path(tops, place)
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = climb(leaf(row, text), steps)
            proof = h(*(x for before, after in steps for x in before + after))
            out.append((row[0], leaf(row, row[1]), levels[-1][0], tops[-1][0], proof, folded, folded == tops[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_of_random_rows(spark, levels):
    r = random.Random(levels)
    rows = awkward.rows(8, 150) + [(7, "twice", "en", "s1", 5)] * 5 + [(7, "other", None, "s1", None), (None, "no id", "en", None, 5), (9, None, None, "alone", None)]
    rows += [(-5, "below\nzero", "é", "ü", 2), (1 << 40, "far\n\nup", "en", "ü", 3), (11, "x", "en", "", 1)]
    rows += [(1000 + i, f"t{i}\n" * r.randrange(3), "en", "hot", i) for i in range(60)]
    docs = awkward.frame(spark, rows, clashing=True)
    got = merkle.proof_report(docs, levels)
    expected = brute(rows)
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=repr) == expected
    assert 0 < sum(not e[6] for e in expected) < len(expected) / 2


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81, 82])
def test_every_number_of_leaves(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    levels = levels_of([x.hex() for x in leaves])
    stack = merkle.Stack()
    witnesses = [stack.append(x) for x in leaves]
    root = stack.close()
    assert root.hex() == levels[-1][0]
    for i, (x, w) in enumerate(zip(leaves, witnesses)):
        assert bytes(w).hex() == "".join(s for before, after in path(levels, i) for s in before + after)
        assert merkle.fold(x, i, n, bytes(w)) == root
        if n > 1:
            assert merkle.fold(x, i, n, bytes(32) + bytes(w)[32:]) != root
            assert merkle.fold(bytes(32), i, n, bytes(w)) != root


def test_later_siblings_extend_witnesses():
    stack = merkle.Stack()
    first = stack.append(b"a" * 32)
    grown = [len(first)]
    for i in range(26):
        stack.append(bytes([i]) * 32)
        grown.append(len(first))
    # Two digests each when the first 3, 9 and 27 leaves are there; only the open subtrees are held.
    assert [grown[i - 1] for i in (2, 3, 8, 9, 26, 27)] == [0, 64, 64, 128, 128, 192]
    assert [len(x) for x in stack.open] == [0, 0, 0, 1]


def test_report_equals_sql(spark, tmp_path):
    rows = awkward.rows(21, 100) + [(3, "again", "en", "s1", 1)] * 2
    docs = awkward.frame(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    mine = spark_rows(merkle.proof_report(docs, 2))
    assert differences(mine, sql_rows(con, oracle.statements()["op12_merkle_manifest"])) == []


def test_manifest_has_what_a_proof_needs(spark):
    rows = awkward.rows(5, 60)
    made = merkle.manifest(awkward.frame(spark, rows), 1).collect()
    for r in made:
        assert r["other"] is None
        top = merkle.fold(bytes(r["leaf"]), r["number"], r["count"], bytes(r["witness"]))
        assert top == bytes(r["subroot"]) and merkle.fold(top, r["source_number"], r["sources"], bytes(r["upper_witness"])) == bytes(r["root"])
    assert {r["root"] for r in made} == {made[0]["root"]}


def test_a_row_that_moves_to_another_part_changes_nothing(spark):
    docs = awkward.frame(spark, awkward.rows(6, 80))
    assert spark_rows(merkle.proof_report(docs, 1)) == spark_rows(merkle.proof_report(docs.dropDuplicates().repartition(5, "text"), 1))


def test_no_rows(spark):
    docs = awkward.frame(spark, awkward.rows(5, 60)).where("false")
    assert merkle.proof_report(docs).count() == 0
