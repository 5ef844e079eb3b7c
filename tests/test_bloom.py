"""The Bloom filter: nothing with a partner is dropped, little else passes, and it acts before rows are moved."""

import re

import pytest
from pyspark.sql import functions as F
from randomdata import frames

from alertloom import reports
from alertloom.operators import bloom, joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("share", [10, 100])
def test_few_pass_by_chance(spark, share):
    rows = spark.range(400_000).select(F.concat(F.lit("a"), "id").alias("alert_id"), "id")
    ids = rows.where(F.col("id") % share == 3).select("alert_id")
    passed = bloom.may_match(rows, ids, "alert_id")
    matches = 400_000 // share
    assert passed.where(F.col("id") % share == 3).count() == matches
    assert passed.count() <= (1.2 if share == 10 else 1.6) * matches


@pytest.mark.parametrize("words", [1, 3, 50])
def test_a_small_filter_only_lets_more_pass(spark, words):
    rows = spark.range(3000).select("id")
    ids = rows.where("id % 7 = 0")
    passed = bloom.may_match(rows, ids, "id", most_words=words)
    assert passed.where("id % 7 = 0").count() == ids.count()
    assert bloom.bloom_join(rows, ids, "id", most_words=words).count() == ids.count()


def test_size_of_the_filter():
    assert bloom.filter_size(0) == 1 and bloom.filter_size(64) == 24
    assert bloom.filter_size(10**9, most_words=10**6) is None
    assert bloom.filter_size(8 * 10**6, most_words=10**6) == 10**6
    assert bloom.filter_size(8 * 10**6 + 1, most_words=10**6) is None


def test_the_filter_holds_the_bits_of_its_ids(spark):
    ids = spark.range(500).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"))
    words = bloom.filter_words(ids, "id", 64).first()["words"]
    assert len(words) == 64
    known = ids.where("id is not null").select(bloom._word(F.col("id"), 64).alias("w"), bloom._mask(F.col("id")).alias("m")).collect()
    whole = [0] * 64
    for r in known:
        assert 1 <= bin(r["m"] & (2**64 - 1)).count("1") <= 5
        whole[r["w"]] |= r["m"] & (2**64 - 1)
    assert [w & (2**64 - 1) for w in words] == whole


@pytest.mark.parametrize("seed", [3, 4])
def test_joins_are_those_without_the_filter(spark, seed):
    alerts, triage = frames(spark, seed)
    one = joins.triage_by_alert(triage)
    plain = alerts.join(one, "alert_id")
    filtered = bloom.bloom_join(alerts, one, "alert_id")
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, filtered.collect()))
    assert bloom.bloom_join(alerts, one.where("false"), "alert_id").count() == 0
    assert bloom.bloom_join(alerts.where("false"), one, "alert_id").count() == 0


def test_the_filter_stands_below_the_exchange(sorted_joins):
    spark = sorted_joins
    alerts = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(F.col("event_id").alias("alert_id"), "value")
    picked = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_id % 10 = 1").select(F.col("event_id").alias("alert_id"))
    joined = bloom.bloom_join(alerts, picked, "alert_id")
    text = plan(joined)
    # The side of the alerts: an exchange, and under it a filter that asks the scalar subquery.
    side = text[text.index("SortMergeJoin") :]
    exchange, found = side.index("Exchange hashpartitioning(alert_id"), re.search(r"Filter .*Subquery", side)
    assert found and exchange < found.start() < side.index("FileScan parquet [event_id", found.start())
    assert "NestedLoop" not in text and "Cartesian" not in text
    joined.collect()
    moved = []

    def walk(node):
        if node.nodeName() == "Exchange":
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    walk(joined._jdf.queryExecution().executedPlan())
    matches = picked.count()
    assert sorted(moved)[0] == matches and sorted(moved)[-1] <= 1.2 * matches


def test_reports_are_the_same_with_the_filter(spark):
    alerts, triage = frames(spark, 9)
    names = ["02", "03", "05", "11", "12"]
    plain, filtered = reports.run(alerts, triage, names), reports.run(alerts, triage, names, bloom=True)
    for name in plain:
        assert list(map(repr, plain[name].collect())) == list(map(repr, filtered[name].collect()))
