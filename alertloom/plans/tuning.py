"""The tuning report: which rules are noisy, and how often they are right."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.operators.joins import outcomes_of, triaged_alerts


def noisy_rules(
    alerts: DataFrame,
    triage: DataFrame,
    min_alerts: int = 2000,
    max_tp_share: float = 0.03,
    keep_tp_share: float = 0.5,
    triaged: DataFrame | None = None,
) -> DataFrame:
    """Volume per (rule, text, level), outcome rates per rule, and a recommendation.

    A rule nobody triaged has no rates and is left to review. `triaged` saves the join if at hand.
    """
    volume = alerts.groupBy("rule_id", "rule_description", "level").agg(
        F.count(F.lit(1)).alias("alerts")
    )
    outcomes = outcomes_of(triaged or triaged_alerts(alerts, triage), "rule_id")
    # The grand total is a scalar subquery over row counts, not a window over every rule.
    total = alerts.agg(F.count(F.lit(1))).scalar()
    tp_share = E.ratio(F.col("true_positives"), F.col("triaged"))
    recommendation = (
        F.when((F.col("alerts") > min_alerts) & (tp_share < max_tp_share), S.TUNE)
        .when(tp_share >= keep_tp_share, S.KEEP)
        .otherwise(S.REVIEW)
    )
    return (
        volume.join(outcomes, "rule_id", "left")
        .withColumn("total", total)
        .select(
            "rule_id",
            "rule_description",
            "level",
            "alerts",
            E.percent(F.col("alerts"), F.col("total")).alias("pct_of_all_alerts"),
            "triaged",
            E.percent(F.col("true_positives"), F.col("triaged")).alias("tp_rate_pct"),
            E.percent(F.col("false_positives"), F.col("triaged")).alias("fp_rate_pct"),
            recommendation.alias("recommendation"),
        )
        .orderBy(
            F.col("alerts").desc_nulls_last(),
            F.col("rule_id").asc_nulls_last(),
            F.col("rule_description").asc_nulls_last(),
            F.col("level").asc_nulls_last(),
        )
    )


def chart_noisy_rules(alerts: DataFrame, triage: DataFrame, top: int = 12, **thresholds) -> DataFrame:
    """Bar-chart input: the largest rules with a short label and the recommendation's first word."""
    verdict = F.substring_index("recommendation", ":", 1)
    return (
        noisy_rules(alerts, triage, **thresholds)
        .limit(top)
        .select(
            "rule_id",
            "level",
            F.substring("rule_description", 1, 48).alias("label"),
            "alerts",
            verdict.alias("verdict"),
        )
    )
