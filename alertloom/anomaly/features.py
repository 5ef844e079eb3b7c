"""What each host did in each hour, and how far that is above its own normal."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E

BREADTH = (
    "alerts",
    "distinct_rules",
    "distinct_users",
    "distinct_src_ips",
    "external_ips",
    "high_sev_alerts",
    "distinct_tactics",
)


def count_features(tactics: Sequence[str] = S.FEATURE_TACTICS) -> list[str]:
    return [*BREADTH, *map(E.tactic_column, tactics)]


def model_features(tactics: Sequence[str] = S.FEATURE_TACTICS) -> list[str]:
    return [f"{c}_excess" for c in count_features(tactics)] + ["max_level", "avg_level"]


def host_hour_features(
    alerts: DataFrame,
    tactics: Sequence[str] = S.FEATURE_TACTICS,
    internal_prefix: str = S.INTERNAL_PREFIX,
    windows: Iterable[tuple[int, int, int]] = S.MAINTENANCE_WINDOWS,
) -> DataFrame:
    """One row per (host, hour) with at least one alert.

    The distinct counts come from grouping sets: alerts are reduced to their distinct rules,
    tactics, users and addresses per host-hour, on the map side first, and those are counted. The
    work of one busy host-hour stays spread over many tasks, and no set is held in memory.
    """
    by = ["agent", "hour"]
    slim = alerts.select(
        "agent",
        E.hour_start(F.col("ts")).alias("hour"),
        "rule_id",
        "src_user",
        "src_ip",
        "mitre_tactic",
        "level",
    )
    # Bits of the grouping id, most significant first; a bit is 0 where the column is grouped.
    dims = ["mitre_tactic", "rule_id", "src_user", "src_ip"]
    sets = [[F.col("agent"), F.col("hour"), F.col(d)] for d in dims]
    level = F.col("level")
    reduced = slim.groupingSets(sets, *by, *dims).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(level >= S.floor_of("high")).alias("high"),
        F.max(level).alias("top"),
        F.sum(level).alias("level_sum"),
        F.count(level).alias("level_n"),
    )
    full = (1 << len(dims)) - 1
    of = {d: F.col("gid") == full - (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)}
    # Every alert is in exactly one group of each set; measures are read from the tactic set.
    base = of["mitre_tactic"]

    def total(col: str, cond: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(base & cond, F.col(col))), F.lit(0).cast("bigint"))

    def distinct(dim: str, cond: Column = F.lit(True)) -> Column:
        return F.count_if(of[dim] & F.col(dim).isNotNull() & cond)

    grouped = reduced.groupBy(*by).agg(
        total("n").alias("alerts"),
        distinct("rule_id").alias("distinct_rules"),
        distinct("src_user").alias("distinct_users"),
        distinct("src_ip").alias("distinct_src_ips"),
        distinct("src_ip", E.is_external(F.col("src_ip"), internal_prefix)).alias("external_ips"),
        F.max("top").alias("max_level"),
        E.ratio(F.sum(F.when(base, F.col("level_sum"))), F.sum(F.when(base, F.col("level_n")))).alias(
            "avg_level"
        ),
        total("high").alias("high_sev_alerts"),
        distinct("mitre_tactic").alias("distinct_tactics"),
        *[total("n", F.col("mitre_tactic") == t).alias(E.tactic_column(t)) for t in tactics],
    )
    return grouped.select(
        "*", F.hour("hour").alias("hour_of_day"), E.iso_weekday(F.col("hour")).alias("weekday")
    ).withColumn(
        "maintenance_window", E.in_maintenance(F.col("weekday"), F.col("hour_of_day"), windows)
    )


def host_hour_excess(
    features: DataFrame,
    tactics: Sequence[str] = S.FEATURE_TACTICS,
    keep: Sequence[str] = (),
    score_decimals: int = 9,
) -> DataFrame:
    """Positive robust excess of every count over the host's own median, and its sum.

    Maintenance hours have their own baseline. A group is one host's active hours, so it is bounded
    by the hours on record; both medians use one partitioning and need one shuffle. Rows without a
    host are a group of their own.

    Every excess and the sum are rounded, so that equal profiles tie whatever the order of addition
    and whichever library took the logarithm.
    """
    counts = count_features(tactics)
    own = Window.partitionBy("agent", "maintenance_window")
    med = {c: F.percentile(c, 0.5).over(own) for c in counts}
    carried = ["agent", "hour", "maintenance_window", "max_level", "avg_level", *keep]
    away = features.select(
        *dict.fromkeys(carried), *[(F.col(c) - med[c]).alias(f"_d_{c}") for c in counts]
    )
    scaled = away.select(
        *dict.fromkeys(carried),
        *[
            F.round(
                F.log1p(
                    F.greatest(
                        F.lit(0.0),
                        F.col(f"_d_{c}")
                        / F.coalesce(
                            F.nullif(F.percentile(F.abs(f"_d_{c}"), 0.5).over(own), F.lit(0.0)), F.lit(1.0)
                        ),
                    )
                ),
                score_decimals,
            ).alias(f"{c}_excess")
            for c in counts
        ],
    )
    score = F.round(reduce(add, [F.col(f"{c}_excess") for c in counts]), score_decimals)
    return scaled.withColumn("excess_score", score).select(
        "agent",
        "hour",
        *[c for c in keep if c not in ("agent", "hour")],
        *model_features(tactics),
        "excess_score",
    )
