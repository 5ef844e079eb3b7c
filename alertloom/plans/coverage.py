"""Gaps: tactics without detections, severe alerts without triage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.joins import outcomes_of, triaged_alerts


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def mitre_coverage(
    alerts: DataFrame, triage: DataFrame, tactics: Sequence[str] = S.TACTICS, triaged: DataFrame | None = None
) -> DataFrame:
    """Rules that fired, alerts and confirmed detections per listed tactic."""
    spark = alerts.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, tactics))).alias("tactic"))

    def of_listed(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("mitre_tactic").isin(*tactics)).withColumnRenamed("mitre_tactic", "tactic")

    relevant = of_listed(alerts)
    volume = relevant.groupBy("tactic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("rule_id").alias("fired")
    )
    outcomes = outcomes_of(of_listed(triaged or triaged_alerts(alerts, triage)), "tactic")
    confirmed = _or_zero("true_positives")
    status = (
        F.when(F.col("n").isNull(), S.BLIND_SPOT).when(confirmed == 0, S.UNCONFIRMED).otherwise(S.COVERED)
    )
    return (
        listed.join(volume, "tactic", "left")
        .join(outcomes, "tactic", "left")
        .select(
            "tactic",
            _or_zero("fired").alias("rules"),
            (_or_zero("n") + _or_zero("repeats")).alias("alerts"),
            confirmed.alias("confirmed_true_positives"),
            status.alias("status"),
        )
        .orderBy(F.col("alerts").desc(), "tactic")
    )


def untriaged_high_severity(
    alerts: DataFrame, triage: DataFrame, min_level: int = 7, triaged: DataFrame | None = None
) -> DataFrame:
    """Alerts and triage actions per level, from `min_level` up."""
    severe = alerts.filter(F.col("level") >= min_level)
    volume = severe.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    known = triaged or triaged_alerts(severe, triage)
    outcomes = outcomes_of(known.filter(F.col("level") >= min_level), "level").withColumnRenamed("triaged", "seen")
    joined = F.col("n") + _or_zero("repeats")
    return (
        volume.join(outcomes, "level", "left")
        .select("level", joined.alias("alerts"), _or_zero("seen").alias("triaged"))
        .select(
            "level",
            "alerts",
            "triaged",
            (F.col("alerts") - F.col("triaged")).alias("untriaged"),
            E.percent(F.col("triaged"), F.col("alerts")).alias("pct_triaged"),
        )
        .orderBy(F.col("level").desc())
    )
