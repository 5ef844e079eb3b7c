"""How fast analysts pick up and close alerts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.joins import triage_latency
from alertloom.operators.quantiles import weighted_quantiles
from alertloom.session import stored


def _histogram(latency: DataFrame, key: Column) -> DataFrame:
    """Triage actions per (key, whole seconds to open), written once.

    Everything the reports need, exact quantiles included, follows from this table. Its size is
    set by the range of latencies, not by the number of alerts, and the join below it runs once.
    """
    working = F.col("working") * F.col("copies")
    return stored(
        latency.groupBy(key, "to_open").agg(
            F.sum("copies").alias("rows"),
            F.sum(working).alias("working"),
            F.sum(F.when(F.col("working").isNotNull(), F.col("copies"))).alias("worked"),
        )
    )


def _with_quantiles(stats: DataFrame, hist: DataFrame, key: str, quantiles: dict[str, float]) -> DataFrame:
    """Add the quantiles of the seconds to open, in minutes."""
    q = weighted_quantiles(hist, key, "to_open", "rows", quantiles).withColumnRenamed(key, "_q")
    return stats.join(q, F.col(key).eqNullSafe(F.col("_q")), "left").withColumns(
        {name: F.round(F.col(name) / F.lit(60.0), 1) for name in quantiles}
    )


def _mean_to_open() -> Column:
    known = F.sum(F.when(F.col("to_open").isNotNull(), F.col("rows")))
    return E.minutes(F.sum(F.col("to_open") * F.col("rows")), known)


def time_to_triage(
    alerts: DataFrame, triage: DataFrame, sla: Mapping[str, float] = S.SLA_MINUTES
) -> DataFrame:
    """Latency and share opened in time, per severity, most severe first."""
    severity = E.severity_band(F.col("level")).alias("severity")
    hist = _histogram(triage_latency(alerts, triage, "level"), severity)
    in_time = F.col("to_open") / F.lit(60.0) <= E.sla_minutes(F.col("severity"), sla)
    stats = hist.groupBy("severity").agg(
        F.sum("rows").alias("triaged"),
        _mean_to_open().alias("mean_min_to_triage"),
        E.minutes(F.sum("working"), F.sum("worked")).alias("mean_min_working"),
        E.percent(F.sum(F.when(in_time, F.col("rows")).otherwise(F.lit(0))), F.sum("rows")).alias(
            "pct_within_sla"
        ),
    )
    return (
        _with_quantiles(stats, hist, "severity", {"p50_min_to_triage": 0.5, "p90_min_to_triage": 0.9})
        .select(
            "severity",
            "triaged",
            "mean_min_to_triage",
            "p50_min_to_triage",
            "p90_min_to_triage",
            "mean_min_working",
            "pct_within_sla",
        )
        .orderBy(E.severity_rank(F.col("severity")))
    )


def triage_by_hour(alerts: DataFrame, triage: DataFrame, min_level: int = 7) -> DataFrame:
    """Latency by the hour of day the alert fired (UTC)."""
    severe = alerts.filter(F.col("level") >= min_level)
    hour_fired = F.hour(E.instant(F.col("ts"))).alias("hour_fired")
    hist = _histogram(triage_latency(severe, triage), hour_fired)
    stats = hist.groupBy("hour_fired").agg(
        F.sum("rows").alias("triaged"), _mean_to_open().alias("mean_min_to_triage")
    )
    return (
        _with_quantiles(stats, hist, "hour_fired", {"p90_min_to_triage": 0.9})
        .select("hour_fired", "triaged", "mean_min_to_triage", "p90_min_to_triage")
        .orderBy(F.col("hour_fired").asc_nulls_last())
    )


def analyst_workload(triage: DataFrame) -> DataFrame:
    """Throughput and outcome mix per analyst."""
    seconds = E.seconds_between(F.col("opened_at"), F.col("closed_at"))
    rows = F.count(F.lit(1))
    outcome = F.col("disposition")
    return (
        triage.select("analyst", "disposition", "escalated", seconds.alias("seconds"))
        .groupBy("analyst")
        .agg(
            rows.alias("alerts_closed"),
            E.minutes(F.sum("seconds"), F.count("seconds")).alias("mean_min_per_alert"),
            E.percent(F.count_if(outcome == S.TRUE_POSITIVE), rows).alias("tp_pct"),
            E.percent(F.count_if(outcome == S.FALSE_POSITIVE), rows).alias("fp_pct"),
            F.count_if(F.col("escalated")).alias("escalations"),
        )
        .orderBy(F.col("alerts_closed").desc(), F.col("analyst").asc_nulls_last())
    )
