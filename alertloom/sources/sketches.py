"""Stored daily sketches: distinct counts and quantiles of any range of days without the alerts.

A day's sketches are small binary columns. Sketches of several days are merged into that of the whole range, which no
sum of daily distinct counts or mean of daily quantiles could give. A table has a folder for each UTC day; writing
replaces the days that are written and leaves the others, so a day can be done again, and a range reads its days only.

Distinct counts are HyperLogLog sketches with 2**lg_k registers: the standard error is 1.04 / sqrt(2**lg_k), and
counts far below that are exact. Quantiles are KLL sketches: the rank of an answer is off by less than 1 percent of
the rows at the default size. Both are aggregated in the tasks first, so an address or a severity with a
third of all rows moves one sketch per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.joins import triage_latency
from alertloom.sources.tables import DAY

LG_K = 12
KLL_SIZE = 800


def write_days(daily: DataFrame, path: str) -> None:
    """Write a table with a `day` column; of the days on record only those in `daily` are replaced."""
    daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The rows of the days from `first` to `last`, both included; only their folders are read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col(DAY) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(DAY) <= F.lit(last))
    return rows


def daily_source_sketches(
    alerts: DataFrame, internal_prefix: str = S.INTERNAL_PREFIX, lg_k: int = LG_K
) -> DataFrame:
    """Per day and external address: alerts, and sketches of its rules, hosts and users.

    Null rules, hosts and users are not counted. Alerts without a time are of no day and are left out.
    """
    day = E.instant(F.col("ts")).cast("date").alias(DAY)
    outside = alerts.where(E.is_external(F.col("src_ip"), internal_prefix) & F.col("ts").isNotNull())
    sketch = {"rules": "rule_id", "hosts": "agent", "users": "src_user"}
    return outside.groupBy(day, "src_ip").agg(
        F.count(F.lit(1)).alias("alerts"), *(F.hll_sketch_agg(c, lg_k).alias(name) for name, c in sketch.items())
    )


def source_breadth(sketches: DataFrame) -> DataFrame:
    """Per address: alerts, and how many rules, hosts and users it met, as far as `sketches` has them, over all its days."""

    def merged(name: str):
        return F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name)

    return sketches.groupBy("src_ip").agg(F.sum("alerts").alias("alerts"), *(merged(c) for c in ("rules", "hosts", "users") if c in sketches.columns))


def approx_source_breadth(sketches: DataFrame, limit: int | None = 15) -> DataFrame:
    """The broadest external addresses: most rules first, then most alerts."""
    out = source_breadth(sketches).orderBy(F.col("rules").desc(), F.col("alerts").desc(), "src_ip")
    return out if limit is None else out.limit(limit)


def daily_latency_sketches(alerts: DataFrame, triage: DataFrame, size: int = KLL_SIZE) -> DataFrame:
    """Per day of the alert and severity: triage actions with known times, and a sketch of their seconds to open."""
    actions = triage_latency(alerts, triage, "level").where("to_open is not null and ts is not null")
    day, severity = E.instant(F.col("ts")).cast("date").alias(DAY), E.severity_band(F.col("level")).alias("severity")
    return actions.groupBy(day, severity).agg(
        F.sum("copies").alias("actions"), F.kll_sketch_agg_bigint("to_open", size).alias("to_open")
    )


def approx_time_to_open(sketches: DataFrame, quantiles: dict[str, float], size: int = KLL_SIZE) -> DataFrame:
    """Per severity: triage actions, and approximate quantiles of the seconds to open, from the sketches of any days."""
    merged = sketches.groupBy("severity").agg(
        F.sum("actions").alias("actions"), F.kll_merge_agg_bigint("to_open", size).alias("to_open")
    )
    found = [F.kll_sketch_get_quantile_bigint("to_open", F.lit(p)).alias(name) for name, p in quantiles.items()]
    return merged.select("severity", "actions", *found)


def rank_bounds(approximate: DataFrame, alerts: DataFrame, triage: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """`approximate`, with the lowest and highest share of exact values that each answer can stand for.

    Counts the triage actions below and up to each answer; an answer q is good for p if low <= p <= high, give or
    take the sketch's error.
    """
    actions = triage_latency(alerts, triage, "level").where("to_open is not null and ts is not null")
    exact = actions.groupBy(E.severity_band(F.col("level")).alias("severity"), F.col("to_open").alias("seconds")).agg(
        F.sum("copies").alias("n")
    )
    joined = exact.join(approximate, "severity")
    shares = []
    for name in quantiles:
        for end, inside in (("low", F.col("seconds") < F.col(name)), ("high", F.col("seconds") <= F.col(name))):
            shares.append((F.sum(F.when(inside, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"{name}_{end}"))
    return approximate.join(joined.groupBy("severity").agg(*shares), "severity")
