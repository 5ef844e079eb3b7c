import zlib
from collections import Counter

import awkward
import pytest
from pyspark.sql import functions as F

from alertloom.llm import order, sharding


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_shards_follow_the_fractional_ranks(spark, shards):
    rows = awkward.rows(3, 200) + [(500, "same", "en", "hot", 1)] * 5
    docs = awkward.frame(spark, rows, clashing=True)
    got = sharding.shard_documents(docs, shards).collect()
    assert len(got) == len(rows)
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) <= set(range(shards)) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
    # By the definition: numbers within the source, fractional ranks, one order, cut.
    mixed = docs.select("doc_id", "source", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"), (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"))
    mixed = mixed.withColumn("mixed", F.xxhash64(F.lit(sharding.SEED), "doc_id", "crc", "size")).collect()
    by_source = {}
    for r in mixed:
        by_source.setdefault(r["source"], []).append((r["mixed"], r["doc_id"]))
    ranked = []
    for members in by_source.values():
        members.sort()
        ranked += [((i + 0.5) / len(members), m, d) for i, (m, d) in enumerate(members)]
    ranked.sort()
    expected = {}
    for i, (_, _, d) in enumerate(ranked):
        expected.setdefault(d, []).append((shards * (i + 1) - 1) // len(ranked))
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r["shard"])
    assert {d: sorted(s) for d, s in found.items()} == {d: sorted(s) for d, s in expected.items()}


def test_every_shard_matches_the_mixture(spark):
    rows = [(i, f"t{i}", "en", ["a", "b", "c", None][min(3, i % 10 // 3)], 1) for i in range(1000)]
    total = Counter(r[3] for r in rows)
    got = sharding.shard_documents(awkward.frame(spark, rows), 8).collect()
    for s in range(8):
        mine = Counter(rows[r["doc_id"]][3] for r in got if r["shard"] == s)
        for source, n in total.items():
            assert abs(mine[source] - n / 8) <= 2


def test_fewer_rows_than_shards_and_empty(spark):
    got = sharding.shard_documents(awkward.frame(spark, awkward.rows(1, 8)[:3])).collect()
    assert len({r["shard"] for r in got}) == 3 and {r["slot"] for r in got} == {0}
    assert sharding.shard_documents(awkward.frame(spark, [])).count() == 0


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    got = order.numbered(df, ["x"], "number").collect()
    assert sorted((r["number"], r["x"]) for r in got) == [(i, i) for i in range(1000)]
