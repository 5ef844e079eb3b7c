"""Hourly counts of alerts that arrive as files."""

import json

from pyspark.sql import functions as F

from alertloom.sources import raw
from alertloom.streaming import hourly


def line(i, time, level=7):
    return json.dumps({"id": i, "timestamp": time and f"2026-08-{time}:00.000+0000", "rule": {"level": level}})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def run(spark, tmp_path, delay="2 days", **reading):
    stream = hourly.alert_stream(spark, str(tmp_path / "in"), **reading)
    query = hourly.keep_hourly_severity(stream, str(tmp_path / "out"), str(tmp_path / "progress"), delay)
    query.awaitTermination()
    return found(hourly.read_hourly_severity(spark, str(tmp_path / "out")))


def found(counts):
    hours = counts.select(F.date_format("hour", "dd'T'HH").alias("h"), "severity", "alerts")
    return sorted(map(tuple, hours.collect()))


def test_a_restart_goes_on_and_equals_the_batch(spark, tmp_path):
    put(tmp_path / "in", "1", line("a", "10T03:10"), line("b", "10T03:50", 12), line("a", "10T03:10"), line(None, "10T03:20"))
    assert run(spark, tmp_path) == [("10T03", "critical", 1), ("10T03", "medium", 2)]
    # Nothing new.
    assert run(spark, tmp_path) == [("10T03", "critical", 1), ("10T03", "medium", 2)]
    put(tmp_path / "in", "2", line("c", "10T05:00", None), line("a", "10T03:10"), line(None, "10T03:20"), line("d", None))
    put(tmp_path / "in", "3", line("e", "10T03:59"))
    expected = [("10T03", "critical", 1), ("10T03", "medium", 4), ("10T05", "low", 1)]
    assert run(spark, tmp_path, files_per_batch=1) == expected
    alerts = raw.load_alerts(spark, str(tmp_path / "in"))
    assert found(hourly.hourly_severity(alerts)) == expected


def test_alerts_behind_the_watermark_are_left_out(spark, tmp_path):
    put(tmp_path / "in", "1", line("a", "10T03:10"))
    run(spark, tmp_path, delay="1 hour")
    put(tmp_path / "in", "2", line("b", "20T03:10"))
    run(spark, tmp_path, delay="1 hour")
    # Within the delay, and far behind it.
    put(tmp_path / "in", "3", line("c", "20T02:40"), line("d", "10T03:15"))
    assert run(spark, tmp_path, delay="1 hour") == [("10T03", "medium", 1), ("20T02", "medium", 1), ("20T03", "medium", 1)]


def test_a_batch_that_runs_again_replaces_its_folder(spark, tmp_path):
    put(tmp_path / "in", "1", line("a", "10T03:10"))
    first = run(spark, tmp_path)
    # The last batch is not on record as done: it runs again.
    commits = sorted((p for p in (tmp_path / "progress" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    assert run(spark, tmp_path) == first
