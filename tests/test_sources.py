"""Loading raw files and storing tables."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F
from randomdata import frames

from alertloom import reports, schemas as S
from alertloom.operators.joins import triage_outcomes
from alertloom.plans import volume
from alertloom.session import scratch_dir, shared_dir, stored
from alertloom.sources import raw, tables
from alertloom.verification import derived


def line(**changes):
    record = {
        "id": "1786331400.1",
        "timestamp": "2026-08-10T03:10:00.000+0000",
        "rule": {
            "id": "5716",
            "level": 7,
            "description": "login failed",
            "groups": ["a"],
            "mitre": {"id": ["T1"], "tactic": ["Credential Access", "Impact"]},
        },
        "agent": {"id": "001", "name": "vpn-01"},
        "manager": {"name": "m"},
        "data": {"srcip": "8.8.8.8"},
        "location": "/var/log",
        "unknown": {"x": 1},
    }
    record.update(changes)
    return json.dumps(record)


def rule(**changes):
    return {"id": "1", "level": 5, "description": "d", **changes}


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_alert_is_flattened(spark, tmp_path):
    row = raw.load_alerts(spark, write(tmp_path, "a.jsonl", line())).first()
    assert row.asDict() == {
        "alert_id": "1786331400.1",
        "ts": dt.datetime(2026, 8, 10, 3, 10),
        "rule_id": "5716",
        "level": 7,
        "rule_description": "login failed",
        "mitre_technique": "T1",
        "mitre_tactic": "Credential Access",
        "agent": "vpn-01",
        "src_ip": "8.8.8.8",
        "src_user": None,
        "dst_user": None,
        "location": "/var/log",
    }


def test_missing_and_empty_tactics_are_null(spark, tmp_path):
    text = "\n".join([line(rule=rule()), line(rule=rule(mitre={"id": [], "tactic": []})), line(rule=rule(level="7"))])
    rows = raw.load_alerts(spark, write(tmp_path, "a.jsonl", text)).collect()
    assert [r["mitre_tactic"] for r in rows] == [None, None, None]
    assert [r["level"] for r in rows] == [5, 5, 7]


@pytest.mark.parametrize(
    "text,micros",
    [("2026-08-10T03:10:00.123+0000", 123000), ("2026-08-10T03:10:00.123456+0000", 123456),
     ("2026-08-10T05:10:00.000+0200", 0), ("2026-08-10T05:10:00.000+02:00", 0)],
)
def test_timestamps(spark, tmp_path, text, micros):
    row = raw.load_alerts(spark, write(tmp_path, "a.jsonl", line(timestamp=text))).first()
    assert row["ts"] == dt.datetime(2026, 8, 10, 3, 10, 0, micros)


@pytest.mark.parametrize("offset", ["+0000", "+00", "+00:00", "-05", "+0530", "+05:30", "-11", "+14", "-0330"])
@pytest.mark.parametrize("fraction", [".123", ".123456"])
def test_offsets_are_read_as_strptime_reads_them(spark, tmp_path, offset, fraction):
    text = f"2026-08-10T03:10:07{fraction}{offset}"
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    expected = con.execute(f"select strptime('{text}', '%Y-%m-%dT%H:%M:%S.%f%z')::timestamp").fetchone()[0]
    path = write(tmp_path, "a.jsonl", line(timestamp=text))
    assert raw.load_alerts(spark, path).first()["ts"] == expected
    good, rejects = raw.load_alerts_with_rejects(spark, path)
    assert good.first()["ts"] == expected and rejects.count() == 0


@pytest.mark.parametrize("text", ["2026-08-10T03:10:07.123+5", "2026-08-10T03:10:07.123", "2026-08-10T03:10-05", "2026-08-10-05"])
def test_other_endings_are_refused(spark, tmp_path, text):
    path = write(tmp_path, "a.jsonl", line(timestamp=text))
    good, rejects = raw.load_alerts_with_rejects(spark, path)
    assert good.count() == 0 and [r["reason"] for r in rejects.collect()] == ["bad timestamp"]


@pytest.mark.parametrize("bad", ["{broken", line(timestamp="yesterday"), line(rule=rule(level="high"))])
def test_strict_load_fails_and_lenient_load_sets_aside(spark, tmp_path, bad):
    path = write(tmp_path, "a.jsonl", line() + "\n" + bad)
    with pytest.raises(Exception):
        raw.load_alerts(spark, path).collect()
    good, rejects = raw.load_alerts_with_rejects(spark, path)
    assert good.count() == 1
    assert [r["line"] for r in rejects.collect()] == [bad]


def test_triage(spark, tmp_path):
    text = (
        "alert_id,opened_at,closed_at,analyst,disposition,escalated\n"
        "1786331400.10,2026-08-10T03:12:00,2026-08-10T03:20:05,ana,true_positive,True\n"
        "2,2026-08-10T03:12:00,,ben,benign,False\n"
    )
    t = raw.load_triage(spark, write(tmp_path, "t.csv", text))
    assert t.schema == S.TRIAGE
    assert [tuple(r) for r in t.collect()] == [
        ("1786331400.10", dt.datetime(2026, 8, 10, 3, 12), dt.datetime(2026, 8, 10, 3, 20, 5), "ana", "true_positive", True),
        ("2", dt.datetime(2026, 8, 10, 3, 12), None, "ben", "benign", False),
    ]


def test_truth_document(spark, tmp_path):
    doc = {"planted_alert_ids": ["1.1", "1.2"], "incidents": {"ssh_brute_force_vpn01": "2026-08-10T03"}}
    path = write(tmp_path, "truth.json", json.dumps(doc, indent=1))
    assert sorted(r[0] for r in raw.load_planted(spark, path).collect()) == ["1.1", "1.2"]
    assert [tuple(r) for r in raw.load_incidents(spark, path).collect()] == [
        ("ssh_brute_force_vpn01", "vpn-01", dt.datetime(2026, 8, 10, 3))
    ]


def test_truth_documents_have_a_bounded_number_of_ids(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    ids = sorted(r["alert_id"] for r in derived.planted(spark, sf).collect())
    documents = derived.truth_document(spark, sf, most=3)
    lists = [json.loads(r["value"]).get("planted_alert_ids", []) for r in documents.collect()]
    assert len(ids) > 3 and max(map(len, lists)) <= 3 and sorted(x for ids_of_one in lists for x in ids_of_one) == ids
    path = str(tmp_path / "truth")
    documents.write.option("maxRecordsPerFile", 1).text(path)
    assert sorted(r[0] for r in raw.load_planted(spark, path).collect()) == ids
    hours = sorted((r["incident"], r["agent"], r["hour"]) for r in derived.incidents(spark, sf).collect())
    assert sorted(map(tuple, raw.load_incidents(spark, path, derived.INCIDENT_HOSTS).collect())) == hours


def test_stored_tables_keep_rows_and_prune_days(spark, tmp_path):
    a, t = frames(spark, 5)
    pa, pt = str(tmp_path / "a"), str(tmp_path / "t")
    for _ in range(2):  # a second write replaces the first
        tables.write_alerts(a, pa)
        tables.write_triage(t, pt)
    stored = tables.read_alerts(spark, pa)
    assert stored.columns == S.ALERTS.names
    assert stored.exceptAll(a).isEmpty() and a.exceptAll(stored).isEmpty()
    assert {r["table_name"]: r["row_count"] for r in tables.load_counts(alerts=stored, triage=tables.read_triage(spark, pt)).collect()} == {
        "alerts": a.count(),
        "triage": t.count(),
    }
    low, high = dt.datetime(2026, 8, 4, 6), dt.datetime(2026, 8, 5)
    some = tables.read_alerts(spark, pa, low, high)
    filters = some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "day" in filters and ">=" in filters and "<=" in filters
    expected = a.filter((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))
    assert some.exceptAll(expected).isEmpty() and expected.exceptAll(some).isEmpty() and not some.isEmpty()


def test_bucketed_tables_join_without_moving_alerts(spark):
    a, t = frames(spark, 6)
    tables.write_bucketed(a, "bucketed_alerts", 4)
    tables.write_bucketed(t, "bucketed_triage", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = triage_outcomes(spark.table("bucketed_alerts"), spark.table("bucketed_triage"), "rule_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(alert_id") == 0
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(
            map(tuple, triage_outcomes(a, t, "rule_id").collect()), key=repr
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("drop table bucketed_alerts")
        spark.sql("drop table bucketed_triage")


def test_reports_run_by_number_and_name_and_are_written(spark, tmp_path):
    a, t = frames(spark, 7)
    results = reports.run(a, t, ["01", "analyst_workload"])
    assert list(results) == ["daily_volume_by_severity", "analyst_workload"]
    for fmt in ("parquet", "csv"):
        reports.write_results(results, str(tmp_path / fmt), fmt)
    back = spark.read.parquet(str(tmp_path / "parquet" / "daily_volume_by_severity"))
    assert back.count() == results["daily_volume_by_severity"].count()
    assert len(reports.run(a, t)) == 12
    with pytest.raises(KeyError):
        reports.select(["16"])


def test_preview_shows_the_first_rows_and_counts_all(spark):
    df = spark.range(100)
    rows, n = reports.preview(df)
    assert (len(rows), n) == (60, 100)
    rows, n = reports.preview(df.limit(5))
    assert (len(rows), n) == (5, 5)


def test_chart_inputs(spark):
    a, _ = frames(spark, 8)
    chart = volume.chart_daily_volume(a)
    assert chart.columns == ["day", "label", "low", "medium", "high", "critical"]
    assert chart.first()["label"] == "Aug 03"


def test_intermediates_go_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    df = stored(spark.range(5))
    assert df.inputFiles()[0].removeprefix("file://").startswith(scratch_dir(spark))
    assert scratch_dir(spark).startswith(folder)
    assert df.count() == 5
