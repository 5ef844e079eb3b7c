"""Unusual volume: hours far above a rule's own mean on a host, and broad external sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E


def scored_hours(alerts: DataFrame) -> DataFrame:
    """Alerts per (rule, host, hour) with the pair's mean and deviation over its active hours."""
    hourly = alerts.groupBy("rule_id", "agent", E.hour_start(F.col("ts")).alias("hour")).agg(
        F.count(F.lit(1)).alias("alerts")
    )
    # One row per active hour of the pair: the window is bounded by the hours on record.
    pair = Window.partitionBy("rule_id", "agent")
    return hourly.select(
        "*",
        F.avg("alerts").over(pair).alias("mean_alerts"),
        F.stddev_samp("alerts").over(pair).alias("sd_alerts"),
    )


def burst_detection(
    alerts: DataFrame, min_z: float = 5.0, limit: int | None = 15
) -> DataFrame:
    """Hours in which a rule fired more than `min_z` deviations above its mean on that host.

    Pairs with one active hour or constant counts have no deviation and are never flagged.
    """
    z = E.ratio(F.col("alerts") - F.col("mean_alerts"), F.col("sd_alerts"))
    order = [
        F.col("z_score").desc(),
        F.col("hour").asc_nulls_last(),
        F.col("rule_id").asc_nulls_last(),
        F.col("agent").asc_nulls_last(),
    ]
    flagged = (
        scored_hours(alerts)
        .filter(z > min_z)
        .withColumn("z_score", F.round(z, 1))
        .withColumn("usual_per_hour", F.round("mean_alerts", 1))
    )
    if limit is not None:
        flagged = flagged.orderBy(*order).limit(limit)
    # Distinct texts are found by hash aggregation first; taking min of text over raw alerts
    # would sort them all.
    texts = (
        alerts.select("rule_id", "rule_description")
        .distinct()
        .groupBy("rule_id")
        .agg(F.min("rule_description").alias("rule_description"))
    )
    return (
        flagged.join(texts, "rule_id", "left")
        .select(
            "hour", "rule_id", "rule_description", "agent", "alerts", "usual_per_hour", "z_score"
        )
        .orderBy(*order)
    )


def top_source_ips(
    alerts: DataFrame,
    internal_prefix: str = S.INTERNAL_PREFIX,
    limit: int | None = 15,
) -> DataFrame:
    """External source addresses, broadest first: rules triggered, hosts touched, first and last seen.

    Alerts are first reduced to (address, rule, host), so neither a busy address nor the two
    distinct counts move raw rows.
    """
    seen = (
        alerts.filter(E.is_external(F.col("src_ip"), internal_prefix))
        .groupBy("src_ip", "rule_id", "agent")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("first_seen"),
            F.max("ts").alias("last_seen"),
            F.max("level").alias("max_level"),
        )
    )
    out = (
        seen.groupBy("src_ip")
        .agg(
            F.sum("n").alias("alerts"),
            F.count_distinct("rule_id").alias("distinct_rules"),
            F.count_distinct("agent").alias("hosts_touched"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.max("max_level").alias("max_level"),
        )
        .orderBy(F.col("distinct_rules").desc(), F.col("alerts").desc(), "src_ip")
    )
    return out if limit is None else out.limit(limit)
