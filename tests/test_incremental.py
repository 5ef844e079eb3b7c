"""Features kept day by day against features of all alerts at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from randomdata import frames

from alertloom.anomaly import incremental
from alertloom.anomaly.features import host_hour_features


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


@pytest.mark.parametrize("seed", [41, 42])
def test_day_by_day_equals_all_at_once(spark, tmp_path, seed):
    alerts, _ = frames(spark, seed)
    path = str(tmp_path / "seen")
    days = sorted(r[0] for r in alerts.select(F.to_date("ts")).distinct().collect())
    for day in days:
        assert incremental.add_alerts(spark, alerts.where(F.to_date("ts") == F.lit(day)), path) == [day]
    whole = host_hour_features(alerts)
    kept = incremental.features_of(incremental.read_seen(spark, path))
    assert rows(kept) == rows(whole) and kept.dtypes == whole.dtypes


def test_late_alerts_meet_the_hours_they_belong_to(spark, tmp_path):
    alerts, _ = frames(spark, 43)
    path = str(tmp_path / "seen")
    alerts = alerts.where("ts is not null").withColumn("late", F.pmod(F.xxhash64("alert_id", "ts", "level"), F.lit(3)))
    for part in range(3):
        incremental.add_alerts(spark, alerts.where(F.col("late") == part).drop("late"), path)
    assert rows(incremental.features_of(incremental.read_seen(spark, path))) == rows(host_hour_features(alerts.drop("late")))


def test_only_touched_days_are_read_and_replaced(spark, tmp_path):
    alerts, _ = frames(spark, 44)
    path = str(tmp_path / "seen")
    incremental.add_alerts(spark, alerts, path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "seen").rglob("*.parquet")}
    day = dt.date(2026, 8, 4)
    text = incremental.read_seen(spark, path, [day])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "2026-08-04" in text
    assert incremental.add_alerts(spark, alerts.where(F.to_date("ts") == F.lit(day)).limit(3), path) == [day]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "seen").rglob("*.parquet")}
    kept = {p: t for p, t in before.items() if "day=2026-08-04" not in str(p)}
    assert kept and kept.items() <= after.items() and not any(p in after for p in before if p not in kept)


def test_nothing_new_changes_nothing(spark, tmp_path):
    alerts, _ = frames(spark, 45)
    path = str(tmp_path / "seen")
    assert incremental.add_alerts(spark, alerts.where("false"), path) == []
    incremental.add_alerts(spark, alerts, path)
    kept = rows(incremental.read_seen(spark, path))
    assert incremental.add_alerts(spark, alerts.where("false"), path) == []
    assert rows(incremental.read_seen(spark, path)) == kept
