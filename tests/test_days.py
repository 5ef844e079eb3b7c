"""Replacing days of stored tables, counts from the writers, the latest triage of an alert."""

import datetime as dt
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from randomdata import START, frames

from alertloom import schemas as S
from alertloom.operators.joins import latest_triage, repeated_triage
from alertloom.sources import tables

DAYS = [START.date() + dt.timedelta(days=i) for i in range(3)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(path, day):
    return {(p.name, p.stat().st_mtime_ns) for p in Path(path, f"day={day}").glob("*.parquet")}


def test_a_second_run_of_a_day_gives_the_same_table(spark, tmp_path):
    a, _ = frames(spark, 1)
    path = str(tmp_path / "a")
    n = tables.write_alerts(a, path)
    assert n == a.count()
    before, others = rows(tables.read_alerts(spark, path)), [files(path, d) for d in DAYS[1:]]
    for _ in range(2):
        day = a.where(F.col("ts").cast("date") == DAYS[0])
        assert tables.replace_days(a, path, DAYS[0], DAYS[0]) == day.count()
        assert rows(tables.read_alerts(spark, path)) == before
    assert [files(path, d) for d in DAYS[1:]] == others


def test_a_day_without_rows_is_emptied_and_others_stay(spark, tmp_path):
    a, _ = frames(spark, 2)
    path = str(tmp_path / "a")
    # An alert without a time is of no day.
    timeless = a.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))
    tables.write_alerts(a.unionByName(timeless), path)
    kept = a.where(F.col("ts").cast("date") == DAYS[1])
    assert tables.replace_days(kept.unionByName(timeless), path, DAYS[0], DAYS[1]) == kept.count()
    expected = a.where(F.col("ts").cast("date").isin(DAYS[1:])).unionByName(timeless)
    assert rows(tables.read_alerts(spark, path)) == rows(expected)
    assert tables.replace_days(a.limit(0), path, DAYS[0], DAYS[2]) == 0
    assert rows(tables.read_alerts(spark, path)) == rows(timeless)


def test_days_of_a_table_that_is_not_there_yet(spark, tmp_path):
    _, t = frames(spark, 3)
    path = str(tmp_path / "t")
    first, last = dt.datetime(2026, 8, 3, 5), dt.datetime(2026, 8, 4, 7)
    tables.replace_days(t, path, DAYS[0], DAYS[1], "opened_at")
    stored = tables.read_triage_days(spark, path, first, last)
    expected = t.where((F.col("opened_at") >= F.lit(first)) & (F.col("opened_at") < F.lit(last)))
    assert rows(stored) == rows(expected) and stored.columns == t.columns
    assert "PartitionFilters: [isnotnull(day" in stored._jdf.queryExecution().toString()


def test_a_failed_run_leaves_the_table(spark, tmp_path):
    a, _ = frames(spark, 4)
    path = str(tmp_path / "a")
    tables.write_alerts(a, path)
    before = rows(tables.read_alerts(spark, path))
    broken = a.withColumn("level", F.when(F.col("agent") == "h1", F.raise_error(F.lit("no"))).otherwise(F.col("level")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tables.replace_days(broken, path, DAYS[0], DAYS[2])
    assert rows(tables.read_alerts(spark, path)) == before


def test_writers_count_empty_tables(spark, tmp_path):
    a, t = frames(spark, 5)
    counts = tables.observed_counts(
        spark,
        alerts=tables.write_alerts(a.limit(0), str(tmp_path / "a")),
        triage=tables.write_triage(t.limit(0), str(tmp_path / "t")),
    )
    assert rows(counts) == [("alerts", 0), ("triage", 0)]


@pytest.mark.parametrize("seed", range(3))
def test_latest_and_repeated_triage(spark, seed):
    _, t = frames(spark, seed)
    actions = defaultdict(list)
    for r in t.collect():
        if r["alert_id"] is not None:
            actions[r["alert_id"]].append(r)
    order = ("closed_at", "opened_at", "analyst", "disposition", "escalated")

    def place(r):
        return [(r[c] is not None, r[c] if r[c] is not None else 0) for c in order]

    def known(of, c):
        return [r[c] for r in of if r[c] is not None]

    last = {k: max(v, key=place) for k, v in actions.items()}
    assert rows(latest_triage(t)) == sorted((tuple(r[c] for c in S.TRIAGE.names) for r in last.values()), key=repr)
    assert rows(repeated_triage(t)) == sorted(
        [
            (k, len(v), len(set(known(v, "analyst"))), min(known(v, "opened_at"), default=None),
             max(known(v, "closed_at"), default=None), len(set(known(v, "disposition"))) > 1)
            for k, v in actions.items() if len(v) > 1
        ],
        key=repr,
    )
