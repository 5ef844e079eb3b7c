"""Expressions at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertloom.functions import exprs as E


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "level,band",
    [(0, "low"), (6, "low"), (7, "medium"), (9, "medium"), (10, "high"), (11, "high"), (12, "critical"), (None, "low")],
)
def test_severity_band(spark, level, band):
    assert one(spark, E.severity_band(F.col("l")), "l int", level) == band


def test_percent_is_double_arithmetic(spark):
    assert one(spark, E.percent(F.col("a"), F.col("b")), "a long, b long", 1, 3) == 33.3
    assert one(spark, E.percent(F.col("a"), F.col("b")), "a long, b long", 1, 0) is None


def test_seconds_count_boundaries_not_elapsed_time(spark):
    a, b = dt.datetime(2026, 1, 1, 0, 0, 0, 900000), dt.datetime(2026, 1, 1, 0, 0, 2, 100000)
    assert one(spark, E.seconds_between(F.col("a"), F.col("b")), "a timestamp, b timestamp", a, b) == 2
    assert one(spark, E.seconds_between(F.col("a"), F.col("b")), "a timestamp, b timestamp_ntz", a, b) == 2


@pytest.mark.parametrize("day,number,name", [(3, 1, "Monday"), (4, 2, "Tuesday"), (9, 7, "Sunday")])
def test_weekday(spark, day, number, name):
    ts = dt.datetime(2026, 8, day)
    assert one(spark, E.iso_weekday(F.col("t")), "t timestamp", ts) == number
    assert one(spark, E.weekday_name(F.col("t")), "t timestamp", ts) == name


def test_week_starts_on_monday(spark):
    assert one(spark, E.week_start(F.col("t")), "t timestamp", dt.datetime(2026, 8, 1, 5)) == dt.date(2026, 7, 27)


@pytest.mark.parametrize(
    "ip,external", [(None, False), ("10.1.2.3", False), ("192.168.1.1", True), ("100.1.1.1", True)]
)
def test_external(spark, ip, external):
    assert one(spark, E.is_external(F.col("ip")), "ip string", ip) is external


@pytest.mark.parametrize("hour,flag", [((1, 59), 0), ((2, 0), 1), ((3, 59), 1), ((4, 0), 0)])
def test_maintenance_window(spark, hour, flag):
    ts = dt.datetime(2026, 8, 4, *hour)  # a Tuesday
    column = E.in_maintenance(E.iso_weekday(F.col("t")), F.hour("t"))
    assert one(spark, column, "t timestamp", ts) == flag
    assert one(spark, column, "t timestamp", ts + dt.timedelta(days=1)) == 0


def test_sla_and_order(spark):
    rows = spark.createDataFrame([(s,) for s in ("low", "critical", "medium", "high")], "s string")
    got = rows.orderBy(E.severity_rank(F.col("s"))).select("s", E.sla_minutes(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("critical", 15), ("high", 30), ("medium", 60), ("low", 240)]
