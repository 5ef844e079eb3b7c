"""Joins between alerts and the triage log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.bloom import bloom_join


def triage_by_alert(triage: DataFrame) -> DataFrame:
    """One row per triaged alert id: number of triage rows and how many had each outcome.

    Its key is unique, so joining alerts to it never multiplies rows, however often one id occurs.
    """
    outcome = F.col("disposition")
    return (
        triage.filter(F.col("alert_id").isNotNull())
        .groupBy("alert_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(outcome == S.TRUE_POSITIVE).alias("tp"),
            F.count_if(outcome == S.FALSE_POSITIVE).alias("fp"),
        )
    )


def triaged_alerts(alerts: DataFrame, triage: DataFrame) -> DataFrame:
    """Every alert that was triaged, with the columns that the reports group by, and its outcomes.

    Stored once, it answers for several reports what each would join all alerts with triage for.
    """
    wanted = ("alert_id", "ts", "rule_id", "level", "mitre_tactic")
    return alerts.select(*wanted).join(triage_by_alert(triage), "alert_id")


def triage_outcomes(alerts: DataFrame, triage: DataFrame, *dims: str) -> DataFrame:
    """Triage outcome counts per alert dimension, as an alerts-to-triage join would count them.

    `triaged`, `true_positives` and `false_positives` count joined rows. `repeats` is the number
    of rows a left join would add beyond one per alert, because some alerts were triaged again.
    """
    return outcomes_of(alerts.select("alert_id", *dims).join(triage_by_alert(triage), "alert_id"), *dims)


def outcomes_of(triaged: DataFrame, *dims: str) -> DataFrame:
    """`triage_outcomes` from alerts that have their outcomes already."""
    return triaged.groupBy(*dims).agg(
        F.sum("n").alias("triaged"),
        F.sum("tp").alias("true_positives"),
        F.sum("fp").alias("false_positives"),
        F.sum(F.col("n") - 1).alias("repeats"),
    )


def triage_latency(alerts: DataFrame, triage: DataFrame, *dims: str) -> DataFrame:
    """Triage actions joined to their alert: `dims`, seconds to open, seconds worked, copies.

    Each triage row travels once, by its alert; copies are few and are added up afterwards.
    """
    actions = triage.filter(F.col("alert_id").isNotNull()).select("alert_id", "opened_at", "closed_at")
    joined = actions.join(alerts.select("alert_id", "ts", *dims), "alert_id").withColumn(
        "copies", F.lit(1).cast("bigint")
    )
    return joined.select(
        *dims,
        "ts",
        E.seconds_between(F.col("ts"), F.col("opened_at")).alias("to_open"),
        E.seconds_between(F.col("opened_at"), F.col("closed_at")).alias("working"),
        "copies",
    )


def escalated_alerts(alerts: DataFrame, triage: DataFrame) -> DataFrame:
    """Every alert that was escalated, with the number of times and the latest closing time.

    A small share of the alerts: a Bloom filter of the escalated ids drops most others before the join moves them.
    """
    escalated = (
        triage.filter(F.col("escalated"))
        .groupBy("alert_id")
        .agg(F.count(F.lit(1)).alias("escalations"), F.max("closed_at").alias("last_closed_at"))
    )
    wanted = ("alert_id", "ts", "rule_id", "level", "mitre_tactic", "agent")
    return bloom_join(alerts.select(*wanted), escalated, "alert_id")


def latest_triage(triage: DataFrame) -> DataFrame:
    """One row per alert id, its latest action: the last closed, of these the last opened, then the last analyst.

    Nulls come first, so an open action is the latest only if none was closed. Rows equal in all three are told apart by
    disposition and escalation. A maximum of structs, found in the tasks first: a hot id moves one row per task.
    Actions without an alert id are left out.
    """
    order = ("closed_at", "opened_at", "analyst", "disposition", "escalated")
    latest = F.max(F.struct(*order)).alias("last")
    found = triage.filter(F.col("alert_id").isNotNull()).groupBy("alert_id").agg(latest)
    return found.select("alert_id", *[F.col(f"last.{c}").alias(c) for c in ("opened_at", "closed_at", "analyst", "disposition", "escalated")])


def repeated_triage(triage: DataFrame) -> DataFrame:
    """Alerts triaged more than once: actions, analysts, first opening, last closing, and whether outcomes differ.

    Null analysts and dispositions are not counted as values.
    """
    outcome = F.col("disposition")
    return (
        triage.filter(F.col("alert_id").isNotNull())
        .groupBy("alert_id")
        .agg(
            F.count(F.lit(1)).alias("actions"),
            F.size(F.collect_set("analyst")).cast("bigint").alias("analysts"),
            F.min("opened_at").alias("first_opened_at"),
            F.max("closed_at").alias("last_closed_at"),
            F.coalesce(F.min(outcome) != F.max(outcome), F.lit(False)).alias("outcomes_differ"),
        )
        .filter(F.col("actions") > 1)
    )


def untriaged_alerts(alerts: DataFrame, triage: DataFrame, min_level: int = 7) -> DataFrame:
    """Alerts at or above `min_level` that nobody opened."""
    return alerts.filter(F.col("level") >= min_level).join(
        triage.select("alert_id"), "alert_id", "left_anti"
    )
