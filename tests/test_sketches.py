"""Stored sketches: errors within their bounds, merged days equal to all at once, and days that can be done again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from randomdata import frames

from alertloom.operators.joins import triage_latency
from alertloom.plans.bursts import top_source_ips
from alertloom.sources import sketches as K


def crowd(spark, n, users, seed=1):
    """Alerts of a few addresses over some days, one of which has most of the users."""
    mixed = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000))
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_786_000_000) + F.col("id") % 5 * 86400).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "8.8.8.8").when(F.col("id") % 3 == 1, "9.9.9.9").otherwise("10.1.1.1").alias("src_ip"),
        F.concat(F.lit("r"), (mixed % 7).cast("string")).alias("rule_id"),
        F.concat(F.lit("h"), (mixed % 40).cast("string")).alias("agent"),
        F.concat(F.lit("u"), (mixed % users).cast("string")).alias("src_user"),
    )


def test_estimates_are_within_the_error_bound(spark, tmp_path):
    alerts = crowd(spark, 300_000, 60_000)
    path = str(tmp_path / "s")
    K.write_days(K.daily_source_sketches(alerts), path)
    got = {r["src_ip"]: r for r in K.source_breadth(K.read_days(spark, path)).collect()}
    exact = alerts.where("src_ip != '10.1.1.1'").groupBy("src_ip").agg(
        F.count("*").alias("alerts"), *(F.count_distinct(c).alias(n) for n, c in (("rules", "rule_id"), ("hosts", "agent"), ("users", "src_user")))
    )
    rows = exact.collect()
    assert set(got) == {r["src_ip"] for r in rows}
    for r in rows:
        mine = got[r["src_ip"]]
        # Three standard errors; what is far below the number of registers is exact.
        assert abs(mine["users"] - r["users"]) <= 3 * 1.04 / 2 ** (K.LG_K / 2) * r["users"]
        assert (mine["alerts"], mine["rules"], mine["hosts"]) == (r["alerts"], r["rules"], r["hosts"])


def test_days_merge_to_the_range(spark, tmp_path):
    alerts, _ = frames(spark, 31)
    path = str(tmp_path / "s")
    K.write_days(K.daily_source_sketches(alerts), path)
    exact = top_source_ips(alerts.where("ts is not null"), limit=None).select(
        "src_ip", "alerts", F.col("distinct_rules").alias("rules"), F.col("hosts_touched").alias("hosts")
    )
    got = K.source_breadth(K.read_days(spark, path)).drop("users")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.collect()))
    # No sum of the days gives it.
    days = K.read_days(spark, path).groupBy("src_ip").agg(F.sum(F.hll_sketch_estimate("rules")).alias("rules"))
    assert sum(r["rules"] for r in days.collect()) > sum(r["rules"] for r in got.collect())


def test_a_range_reads_sketches_of_its_days_only(spark, tmp_path):
    alerts, _ = frames(spark, 32)
    path = str(tmp_path / "s")
    K.write_days(K.daily_source_sketches(alerts), path)
    first, last = dt.date(2026, 8, 4), dt.date(2026, 8, 5)
    some = K.read_days(spark, path, first, last)
    text = K.approx_source_breadth(some)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "PartitionFilters: [isnotnull(day" in text and "2026-08-04" in text
    inside = alerts.where("ts >= '2026-08-04' and ts < '2026-08-06'")
    assert sorted(map(tuple, K.source_breadth(some).collect())) == sorted(
        map(tuple, K.source_breadth(K.daily_source_sketches(inside)).collect())
    )


def test_a_day_done_again_replaces_itself_only(spark, tmp_path):
    alerts, _ = frames(spark, 33)
    path = str(tmp_path / "s")
    K.write_days(K.daily_source_sketches(alerts), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")}
    answers = sorted(map(tuple, K.source_breadth(K.read_days(spark, path)).collect()))
    again = alerts.where("cast(ts as date) = '2026-08-04'")
    for _ in range(2):
        K.write_days(K.daily_source_sketches(again), path)
    assert sorted(map(tuple, K.source_breadth(K.read_days(spark, path)).collect())) == answers
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")}
    kept = {p: t for p, t in before.items() if "day=2026-08-04" not in str(p)}
    assert kept and kept.items() <= after.items() and len(kept) < len(before)


QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_are_within_one_percent(spark, tmp_path, seed):
    r = random.Random(seed)
    start = dt.datetime(2026, 8, 3)
    rows = []
    for _ in range(60_000):
        seconds = r.choice([int(r.lognormvariate(6, 2)), r.randrange(100), 600])
        rows.append((start + dt.timedelta(days=r.randrange(6)), r.choice([3, 8, 12]), seconds))
    values = spark.createDataFrame(rows, "ts timestamp_ntz, level int, seconds long").withColumn("alert_id", F.monotonically_increasing_id().cast("string"))
    values.write.parquet(str(tmp_path / "v"))
    values = spark.read.parquet(str(tmp_path / "v"))
    opened = F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("seconds")).cast("timestamp_ntz")
    triage = values.select("alert_id", opened.alias("opened_at"), opened.alias("closed_at"))
    alerts = values.select("alert_id", "ts", "level")
    K.write_days(K.daily_latency_sketches(alerts, triage), str(tmp_path / "s"))
    found = K.approx_time_to_open(K.read_days(spark, str(tmp_path / "s")), QUANTILES).collect()
    assert sum(x["actions"] for x in found) == 60_000
    bands = {"low": [3], "medium": [8], "critical": [12]}
    for x in found:
        mine = sorted(s for _, level, s in rows if level in bands[x["severity"]])
        assert len(mine) == x["actions"]
        for name, p in QUANTILES.items():
            below = sum(s < x[name] for s in mine) / len(mine)
            upto = sum(s <= x[name] for s in mine) / len(mine)
            assert below - 0.01 <= p <= upto + 0.01


def test_bounds_count_the_exact_values(spark):
    alerts, triage = frames(spark, 35)
    exact = {}
    for r in triage_latency(alerts, triage, "level").where("to_open is not null and ts is not null").collect():
        band = next((n for n, f in (("critical", 12), ("high", 10), ("medium", 7)) if r["level"] is not None and r["level"] >= f), "low")
        exact.setdefault(band, []).append(r["to_open"])
    sketches = K.daily_latency_sketches(alerts, triage)
    got = K.rank_bounds(K.approx_time_to_open(sketches, {"p50": 0.5}), alerts, triage, {"p50": 0.5}).collect()
    assert {r["severity"]: r["actions"] for r in got} == {k: len(v) for k, v in exact.items()}
    for r in got:
        mine = exact[r["severity"]]
        assert r["p50_low"] == pytest.approx(sum(x < r["p50"] for x in mine) / len(mine))
        assert r["p50_high"] == pytest.approx(sum(x <= r["p50"] for x in mine) / len(mine))
        assert r["p50_low"] - 0.01 <= 0.5 <= r["p50_high"] + 0.01


def test_no_rows(spark, tmp_path):
    alerts, triage = frames(spark, 36)
    none = K.daily_source_sketches(alerts.where("false"))
    assert K.approx_source_breadth(none).count() == 0
    assert K.approx_time_to_open(K.daily_latency_sketches(alerts, triage.where("false")), QUANTILES).count() == 0
