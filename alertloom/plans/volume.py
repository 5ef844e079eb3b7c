"""Alert volume over time, and what tuning would remove."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.joins import outcomes_of, triage_outcomes, triaged_alerts


def daily_volume_by_severity(alerts: DataFrame) -> DataFrame:
    """Alerts per day and severity band. An alert without a level is only in `total`."""
    band = F.when(F.col("level").isNotNull(), E.severity_band(F.col("level")))
    return (
        alerts.groupBy(E.instant(F.col("ts")).cast("date").alias("day"))
        .agg(
            *[F.count_if(band == name).alias(name) for name in reversed(S.SEVERITY_ORDER)],
            F.count(F.lit(1)).alias("total"),
        )
        .orderBy(F.col("day").asc_nulls_last())
    )


def hourly_heatmap(alerts: DataFrame) -> DataFrame:
    """Alerts per weekday and hour of day, one row per cell that occurs."""
    ts = E.instant(F.col("ts"))
    return (
        alerts.groupBy(
            E.weekday_name(ts).alias("weekday"),
            E.iso_weekday(ts).alias("dow_num"),
            F.hour(ts).alias("hour"),
        )
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(F.col("dow_num").asc_nulls_last(), F.col("hour").asc_nulls_last())
    )


def hourly_heatmap_grid(alerts: DataFrame) -> DataFrame:
    """The heatmap as a grid: a row per weekday, a column per hour; empty cells are NULL."""
    hours = list(range(24))
    grid = (
        hourly_heatmap(alerts)
        .groupBy("dow_num")
        .pivot("hour", hours)
        .agg(F.sum("alerts"))
    )
    return grid.select(
        "dow_num", *[F.col(f"`{h}`").cast("bigint").alias(f"h{h:02d}") for h in hours]
    ).orderBy("dow_num")


def tuning_candidates(
    alerts: DataFrame,
    triage: DataFrame,
    min_alerts: int = 2000,
    max_tp_share: float = 0.03,
) -> DataFrame:
    """Rules with more than `min_alerts` alerts and a true-positive share below `max_tp_share`.

    Volume counts the rows of alerts left-joined to triage: an alert triaged twice counts twice.
    """
    volume = alerts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    outcomes = triage_outcomes(alerts, triage, "rule_id")
    return _tunable(volume, outcomes, min_alerts, max_tp_share).select("rule_id")


def _tunable(volume: DataFrame, outcomes: DataFrame, min_alerts: int, max_tp_share: float) -> DataFrame:
    # Null-safe: alerts without a rule form a group of their own.
    o = outcomes.withColumnRenamed("rule_id", "o_rule")
    return volume.join(o, F.col("rule_id").eqNullSafe(F.col("o_rule"))).filter(
        (F.col("n") + F.col("repeats") > min_alerts)
        & (E.ratio(F.col("true_positives"), F.col("triaged")) < max_tp_share)
    )


def weekly_trend_after_tuning(
    alerts: DataFrame,
    triage: DataFrame,
    min_alerts: int = 2000,
    max_tp_share: float = 0.03,
    triaged: DataFrame | None = None,
) -> DataFrame:
    """Weekly alerts, and how many would remain with the tuning candidates suppressed.

    Follows SQL's NOT IN: with candidates present an alert without a rule is not counted as
    remaining, and a candidate without a rule id leaves nothing remaining.
    """
    # Alerts are reduced to (week, rule) once; the candidates and the trend start from there, so
    # no join touches single alerts except the one that finds the triaged ones.
    weekly_rules = alerts.groupBy(E.week_start(F.col("ts")).alias("week"), "rule_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    volume = weekly_rules.groupBy("rule_id").agg(F.sum("n").alias("n"))
    outcomes = outcomes_of(triaged or triaged_alerts(alerts, triage), "rule_id")
    tune = _tunable(volume, outcomes, min_alerts, max_tp_share).select(
        F.col("rule_id").alias("tuned"), F.lit(True).alias("hit")
    )
    found = tune.agg(
        F.struct(
            F.count(F.lit(1)).alias("rules"), F.count_if(F.col("tuned").isNull()).alias("nameless")
        )
    ).scalar()
    remains = (
        F.when(F.col("found.rules") == 0, True)
        .when(F.col("found.nameless") > 0, False)
        .otherwise(F.col("rule_id").isNotNull() & F.col("hit").isNull())
    )
    weekly = (
        weekly_rules.join(tune, F.col("rule_id").eqNullSafe(F.col("tuned")), "left")
        .withColumn("found", found)
        .groupBy("week")
        .agg(
            F.sum("n").alias("alerts"),
            F.sum(F.when(remains, F.col("n")).otherwise(F.lit(0))).alias("alerts_after_tuning"),
        )
    )
    removed = F.col("alerts") - F.col("alerts_after_tuning")
    return weekly.select(
        "week",
        "alerts",
        "alerts_after_tuning",
        E.percent(removed, F.col("alerts")).alias("pct_reduction"),
    ).orderBy(F.col("week").asc_nulls_last())


def chart_daily_volume(alerts: DataFrame) -> DataFrame:
    """Stacked-bar input: a day label and the four severity counts."""
    return daily_volume_by_severity(alerts).select(
        "day", F.date_format("day", "MMM dd").alias("label"), *reversed(S.SEVERITY_ORDER)
    )
