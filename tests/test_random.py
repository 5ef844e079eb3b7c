"""Operators against SQL on random tables with NULLs, copies, repeated triage and hot keys."""

import duckdb
import pytest
from compare import differences, spark_rows, sql_rows
from randomdata import frames, load_duckdb

from pyspark.sql import functions as F

from alertloom.anomaly import evaluate, features, ranking
from alertloom.operators.chains import attack_chains
from alertloom.operators.joins import untriaged_alerts
from alertloom.plans import bursts, coverage, latency, tuning, volume
from alertloom.session import stored
from alertloom.verification import oracle

MIN_ALERTS = 90
SQL = oracle.statements(MIN_ALERTS)
PREFIX = "with planted as (select alert_id from alerts where level = 15 and rule_id = 'r1')"

# name -> operator on (alerts, triage)
OPERATORS = {
    "daily_volume_by_severity": lambda a, t: volume.daily_volume_by_severity(a),
    "noisy_rules": lambda a, t: tuning.noisy_rules(a, t, min_alerts=MIN_ALERTS, max_tp_share=0.03),
    "mitre_coverage": coverage.mitre_coverage,
    "hourly_heatmap": lambda a, t: volume.hourly_heatmap(a),
    "hourly_heatmap_grid": lambda a, t: volume.hourly_heatmap_grid(a),
    "all_bursts": lambda a, t: bursts.burst_detection(a, limit=None),
    "top_source_ips": lambda a, t: bursts.top_source_ips(a),
    "attack_chains": lambda a, t: attack_chains(a),
    "all_attack_chains": lambda a, t: attack_chains(a, limit=None),
    "analyst_workload": lambda a, t: latency.analyst_workload(t),
    "untriaged_high_severity": coverage.untriaged_high_severity,
    "untriaged_alerts": untriaged_alerts,
    "tuning_candidates": lambda a, t: volume.tuning_candidates(a, t, min_alerts=MIN_ALERTS),
    "weekly_trend_after_tuning": lambda a, t: volume.weekly_trend_after_tuning(a, t, min_alerts=MIN_ALERTS),
    "host_hour_features": lambda a, t: features.host_hour_features(a),
    "host_hour_excess": lambda a, t: _rounded(features.host_hour_excess(features.host_hour_features(a))),
    "baseline_ranking": lambda a, t: _ranked(a).select(*BASELINE),
    "baseline_precision_recall_at_k": lambda a, t: evaluate.precision_recall_at_k(_ranked(a), methods=evaluate.BASELINES),
}
BASELINE = ["agent", "hour", "alerts", "excess_score", "is_malicious", "heur_rank", "volume_rank"]


def _rounded(excess):
    model = features.model_features()
    return excess.select("agent", "hour", *[F.round(c, 9).alias(c) for c in model], "excess_score")


def _planted(alerts):
    return alerts.filter("level = 15 and rule_id = 'r1'").select("alert_id")


def _ranked(alerts):
    truth = ranking.malicious_host_hours(alerts, _planted(alerts))
    return ranking.baseline_ranking(stored(ranking.flag_malicious(ranking.excess_table(alerts), truth)))


def expected(con, name):
    return sql_rows(con, SQL[name].replace(oracle.BASE, PREFIX))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    return c


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_matches_sql(spark, con, name, seed):
    load_duckdb(con, seed)
    mine = spark_rows(OPERATORS[name](*frames(spark, seed)))
    assert differences(mine, expected(con, name)) == []


def without_quantiles(rows, names):
    """Rows without the named columns, and those columns apart: an interpolated value that falls on
    a rounding boundary may differ in its last float digit and so be rounded either way."""
    columns, data = rows
    at = [columns.index(n) for n in names]
    rest = [tuple(v for i, v in enumerate(r) if i not in at) for r in data]
    order = sorted(range(len(data)), key=lambda i: repr(rest[i]))
    return [rest[i] for i in order], [[data[i][j] for j in at] for i in order]


def assert_latency(mine, theirs, *quantiles):
    assert mine[0] == theirs[0]
    (rows, values), (sql, sql_values) = (without_quantiles(r, quantiles) for r in (mine, theirs))
    assert rows == sql
    for got, want in zip(values, sql_values):
        assert got == pytest.approx(want, abs=0.1000001)


QUANTILES = {
    "time_to_triage": ["p50_min_to_triage", "p90_min_to_triage"],
    "triage_by_hour": ["p90_min_to_triage"],
}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("name", sorted(QUANTILES))
def test_latency(spark, con, name, seed):
    load_duckdb(con, seed)
    mine = spark_rows(getattr(latency, name)(*frames(spark, seed)))
    assert_latency(mine, expected(con, name), *QUANTILES[name])


@pytest.mark.parametrize("seed", [1, 2])
def test_malicious_host_hours(spark, con, seed):
    load_duckdb(con, seed)
    a, _ = frames(spark, seed)
    mine = spark_rows(ranking.malicious_host_hours(a, _planted(a)))
    assert differences(mine, expected(con, "malicious_host_hours")) == []
