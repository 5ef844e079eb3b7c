"""The alerts behind a reported chain, one row for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.functions import exprs as E
from alertloom.operators.chains import attack_chains
from alertloom.operators.intervals import TOGETHER, points_in_ranges
from alertloom.operators.timeline import MICROS
from alertloom.session import stored


def chain_members(
    alerts: DataFrame, chains: DataFrame, min_level: int = 8, window_seconds: int = 7200, together: int = TOGETHER
) -> DataFrame:
    """Per chain and alert in its window: the chain's first_host, src_user and window_start, and the alert.

    `shares` tells whether the alert has the chain's host, its user or both. Chains are taken as `attack_chains` gives
    them, each once; severe alerts without a tactic belong to none, as there. Hosts and users are joined on their
    own, so an alert with both comes once, from the host's side. The severe alerts are written once.
    """
    window = window_seconds * MICROS
    severe = alerts.where((F.col("level") >= min_level) & F.col("mitre_tactic").isNotNull() & F.col("ts").isNotNull())
    points = stored(
        severe.select(
            "alert_id", "ts", "rule_id", "level", "mitre_tactic", "agent", F.col("src_user").alias("user"),
            F.unix_micros(E.instant(F.col("ts"))).alias("at"),
        ).hint("rebalance")
    )
    start = F.unix_micros(E.instant(F.col("window_start")))
    ranges = stored(
        chains.select("first_host", "src_user", "window_start").distinct()
        .withColumns({"low": start, "high": start + window})
    )
    columns = ["first_host", "src_user", "window_start", "alert_id", "ts", "rule_id", "level", "mitre_tactic", "agent", "user"]

    def met(point: str, chain: str) -> DataFrame:
        p, r = points.withColumn("key", F.col(point)), ranges.withColumn("key", F.col(chain))
        return points_in_ranges(p, r, ["key"], "at", "low", "high", window, together)

    same_user = F.coalesce(F.col("user") == F.col("src_user"), F.lit(False))
    by_host = met("agent", "first_host").withColumn("shares", F.when(same_user, "both").otherwise("host"))
    elsewhere = ~F.coalesce(F.col("agent") == F.col("first_host"), F.lit(False))
    by_user = met("user", "src_user").where(elsewhere).withColumn("shares", F.lit("user"))
    return by_host.unionByName(by_user).select(*columns, "shares")


def attack_chain_members(alerts: DataFrame, limit: int | None = 10, min_level: int = 8, window_seconds: int = 7200) -> DataFrame:
    """The alerts of the reported chains."""
    chains = attack_chains(alerts, min_level=min_level, window_seconds=window_seconds, limit=limit)
    return chain_members(alerts, chains, min_level, window_seconds)
