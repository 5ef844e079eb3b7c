"""Reports at their thresholds, and what must agree between them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertloom import reports, schemas as S
from alertloom.plans import bursts, coverage, latency, tuning, volume
from alertloom.verification import derived
from randomdata import frames as random_frames

DAY = dt.datetime(2026, 8, 3)


def alert(i, rule="r", ts=DAY, level=5, text="d", tactic=None, agent="h", ip=None):
    return (str(i), ts, rule, level, text, None, tactic, agent, ip, None, None, None)


def triaged(i, outcome="benign", minutes=1):
    opened = DAY + dt.timedelta(minutes=minutes)
    return (str(i), opened, opened + dt.timedelta(minutes=2), "ana", outcome, False)


def frames(spark, alerts, triage):
    return spark.createDataFrame(alerts, S.ALERTS), spark.createDataFrame(triage, S.TRIAGE)


@pytest.mark.parametrize(
    "alerts,tp,of,verdict",
    [
        (101, 2, 100, S.TUNE),
        (100, 2, 100, S.REVIEW),  # not above the volume threshold
        (101, 3, 100, S.REVIEW),  # exactly 3 percent
        (4, 2, 4, S.KEEP),  # exactly half
        (101, 0, 0, S.REVIEW),  # never triaged
    ],
)
def test_recommendation_thresholds(spark, alerts, tp, of, verdict):
    a, t = frames(
        spark,
        [alert(i) for i in range(alerts)],
        [triaged(i, S.TRUE_POSITIVE if i < tp else S.FALSE_POSITIVE) for i in range(of)] or [triaged("none")],
    )
    row = tuning.noisy_rules(a, t, min_alerts=100).first()
    assert row["recommendation"] == verdict
    assert row["triaged"] == (of or None)
    assert row["tp_rate_pct"] == (round(100 * tp / of, 1) if of else None)
    listed = [r[0] for r in volume.tuning_candidates(a, t, min_alerts=100).collect()]
    assert listed == (["r"] if verdict == S.TUNE else [])


def test_rule_with_two_texts_shares_its_outcomes(spark):
    a, t = frames(spark, [alert(1), alert(2, text="e")], [triaged(1, S.TRUE_POSITIVE)])
    rows = tuning.noisy_rules(a, t).collect()
    assert [(r["alerts"], r["triaged"], r["tp_rate_pct"]) for r in rows] == [(1, 1, 100.0)] * 2


def test_alert_without_rule_is_dropped_only_when_something_is_tuned(spark):
    quiet = [alert(i) for i in range(5)] + [alert("n", rule=None)]
    a, t = frames(spark, quiet, [triaged(0)])
    assert volume.weekly_trend_after_tuning(a, t, min_alerts=100).first()["alerts_after_tuning"] == 6
    assert volume.weekly_trend_after_tuning(a, t, min_alerts=2).first()["alerts_after_tuning"] == 0
    # A tuned rule without an id leaves nothing.
    nameless = [alert(i, rule=None) for i in range(5)] + [alert("x", rule="other")]
    a, t = frames(spark, nameless, [triaged(0)])
    assert volume.weekly_trend_after_tuning(a, t, min_alerts=2).first()["alerts_after_tuning"] == 0


def test_repeated_and_orphan_triage(spark):
    a, t = frames(
        spark,
        [alert(1, level=8, tactic="Impact"), alert(2, level=8, tactic="Made Up")],
        [triaged(1, S.TRUE_POSITIVE), triaged(1, S.TRUE_POSITIVE, 5), triaged("orphan")],
    )
    covered = {r["tactic"]: r for r in coverage.mitre_coverage(a, t).collect()}
    assert len(covered) == 12
    impact = covered["Impact"]
    assert (impact["rules"], impact["alerts"], impact["confirmed_true_positives"]) == (1, 2, 2)
    assert impact["status"] == S.COVERED and covered["Discovery"]["status"] == S.BLIND_SPOT
    gap = coverage.untriaged_high_severity(a, t).first()
    assert tuple(gap) == (8, 3, 2, 1, 66.7)
    assert latency.analyst_workload(t).first()["alerts_closed"] == 3
    assert tuning.noisy_rules(a, t).first()["triaged"] == 2


@pytest.mark.parametrize("ones,flagged", [(26, True), (25, False)])
def test_burst_needs_enough_active_hours(spark, ones, flagged):
    hour = dt.timedelta(hours=1)
    rows = [alert(i, ts=DAY + i * hour) for i in range(ones)]
    rows += [alert(f"s{i}", ts=DAY + 200 * hour) for i in range(500)]
    a, _ = frames(spark, rows, [triaged(0)])
    assert (bursts.burst_detection(a).count() == 1) is flagged


def test_constant_and_single_hours_are_never_bursts(spark):
    hour = dt.timedelta(hours=1)
    rows = [alert(i, ts=DAY + i * hour) for i in range(40)] + [alert("x", rule="q")]
    a, _ = frames(spark, rows, [triaged(0)])
    assert bursts.burst_detection(a, min_z=-1e9).count() == 0


def test_invariants_between_reports(spark):
    sf = "/root/testdata/sf0.001"
    a, t = derived.alerts(spark, sf), derived.triage(spark, sf)

    def total(df, col):
        return df.agg(F.sum(col)).first()[0]

    daily = volume.daily_volume_by_severity(a)
    n, m = a.count(), t.count()
    noisy = tuning.noisy_rules(a, t)
    assert total(daily, "total") == n == sum(total(daily, c) for c in S.SEVERITY_ORDER)
    assert total(noisy, "alerts") == total(volume.hourly_heatmap(a), "alerts") == n
    assert total(volume.weekly_trend_after_tuning(a, t), "alerts") == n
    assert total(latency.time_to_triage(a, t), "triaged") == total(latency.analyst_workload(t), "alerts_closed") == m
    gap = coverage.untriaged_high_severity(a, t)
    assert total(latency.triage_by_hour(a, t), "triaged") == total(gap, "triaged")
    assert total(gap, "alerts") == sum(total(daily, c) for c in ("medium", "high", "critical"))
    assert total(coverage.mitre_coverage(a, t), "alerts") == a.filter(F.col("mitre_tactic").isin(*S.TACTICS)).count()


def test_quantiles_of_a_wide_histogram(spark):
    import random

    import numpy as np

    from alertloom.operators.quantiles import weighted_quantiles

    r = random.Random(3)
    rows = [(k, v, r.randrange(1, 5)) for k in ("a", None) for v in r.sample(range(-5000, 40000), 300)]
    hist = spark.createDataFrame([*rows, ("a", None, 9)], "k string, v bigint, n bigint")
    got = {x["k"]: x for x in weighted_quantiles(hist, "k", "v", "n", {"p5": 0.5, "p9": 0.9, "p0": 0.0, "p1": 1.0}).collect()}
    for key in ("a", None):
        values = np.repeat([v for k, v, _ in rows if k == key], [n for k, _, n in rows if k == key])
        want = np.quantile(values, [0.5, 0.9, 0, 1])
        assert [got[key][c] for c in ("p5", "p9", "p0", "p1")] == pytest.approx(list(want))


def test_settings_grow_with_the_data():
    from alertloom.session import sized_settings

    assert sized_settings(10**6)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    assert sized_settings(10**12)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "7451"
    assert sized_settings(10**14)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "745059"


# Reports that write a part of theirs when they are built; all others only build a plan.
RUN_JOBS = {"time_to_triage", "triage_by_hour", "attack_chains"}


@pytest.mark.parametrize("name", [r.name for r in reports.REPORTS])
def test_building_a_report_runs_no_jobs_unless_it_says_so(spark, name):
    a, t = random_frames(spark, 9)
    group = f"build {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        reports.run(a, t, [name])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    assert bool(jobs) == (name in RUN_JOBS)


def test_scratch_is_dropped_on_request(spark, tmp_path, monkeypatch):
    from alertloom import session

    monkeypatch.setattr(session, "scratch_dir", lambda spark: str(tmp_path / "scratch"))
    assert session.stored(spark.range(3)).count() == 3
    assert session.drop_scratch(spark)
    assert not (tmp_path / "scratch").exists()
