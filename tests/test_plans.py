"""Physical plans: no nested loops, no gathering, filters and columns pushed into the scan."""

import re

import pytest
from randomdata import frames

import __spark_entry__ as entry
from alertloom import reports
from alertloom.operators import chains, joins
from alertloom.plans import bursts, coverage, volume
from alertloom.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "noisy_rules", "time_to_triage", "triage_by_hour", "mitre_coverage", "burst_detection",
        "top_source_ips", "attack_chains", "all_attack_chains", "untriaged_high_severity",
        "weekly_trend_after_tuning", "host_hour_features", "host_hour_excess", "malicious_host_hours",
    ],
)
def test_no_nested_loops(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # A window over everything in one task is only ever used on one row per partition.
    assert "Exchange SinglePartition" not in text or "Window" not in text.split("Exchange SinglePartition")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    a, t = frames(spark, 12)
    root = tmp_path_factory.mktemp("tables")
    tables.write_alerts(a, f"{root}/a")
    tables.write_triage(t, f"{root}/t")
    return tables.read_alerts(spark, f"{root}/a"), tables.read_triage(spark, f"{root}/t")


def scans(df):
    return re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan(df))


def test_only_needed_columns_are_read(stored):
    (columns, _), = scans(volume.daily_volume_by_severity(stored[0]))
    assert {c.split("#")[0] for c in columns.split(",")} == {"ts", "level", "day"}


def test_filters_reach_the_scan(stored):
    for columns, pushed in scans(coverage.untriaged_high_severity(*stored)):
        assert "level#" not in columns or "GreaterThanOrEqual(level,7)" in pushed
    (_, pushed), = scans(bursts.top_source_ips(stored[0]))
    assert "Not(StringStartsWith(src_ip,10.))" in pushed


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def by_alert(df):
    return plan(df).count("Exchange hashpartitioning(alert_id")


def test_latency_moves_triage_and_alerts_once(stored, no_broadcast):
    assert by_alert(joins.triage_latency(*stored, "level")) == 2


def test_reports_share_one_join_of_all_alerts(stored, no_broadcast, monkeypatch):
    joined = []
    shared = joins.triaged_alerts(*stored)
    monkeypatch.setattr(reports, "triaged_alerts", lambda a, t: joined.append(1) or shared)
    results = reports.run(*stored)
    # One exchange for alerts and one for triage, once; then no report joins alerts with triage again.
    assert joined == [1] and by_alert(shared) == 2
    for name in ("noisy_rules", "mitre_coverage", "untriaged_high_severity", "weekly_trend_after_tuning"):
        assert by_alert(results[name]) == 0, name


def test_chains_carry_tactics_and_not_times(spark, stored, no_broadcast):
    severe = chains._severe(stored[0], 8)
    window = 7200 * 10**6
    text = plan(chains._candidates(severe, 3, window))
    assert "NestedLoop" not in text and "Broadcast" not in text
    anchors = severe.select("agent", "src_user", "t").withColumn("slot", chains.slot_of(chains.F.col("t"), window))
    by_host = chains._seen_by(anchors, chains._tactic_times(severe, window), chains.HOST, "agent", window)
    # What goes on to the join by user are names, not the list of times.
    assert dict(by_host.dtypes)["agent_tactics"] == "array<string>" and "times" not in by_host.columns

