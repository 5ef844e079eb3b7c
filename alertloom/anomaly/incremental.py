"""Host-hour features kept up to date day by day, without reading old alerts again.

What was seen in a host-hour is stored as a table of its distinct values with the counts that belong to them: one row
for each (host, hour, kind, value), a folder for each UTC day. New alerts are reduced to rows of the same form, which
meet the stored ones of their days only; everything that the features need is a sum, a maximum or a distinct value, so
the merged rows are what all alerts at once would have given. Features of the touched days follow from them.

A day is replaced as a whole by a dynamic overwrite of its folder, from a copy that is written beside the table first,
so a failed run leaves the table as it was and can be done again. Alerts must come once: each call adds what it is given.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.session import stored
from alertloom.sources.tables import DAY

# The values of a host-hour, by the column that they come from. Every alert has one row of the first kind.
KINDS = ("mitre_tactic", "rule_id", "src_user", "src_ip")
_KEY = [DAY, "agent", "hour", "kind", "value"]


def _sums() -> list[Column]:
    return [
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.max("top").alias("top"),
        F.sum("level_sum").alias("level_sum"), F.sum("level_n").alias("level_n"),
    ]


def seen_values(alerts: DataFrame) -> DataFrame:
    """Per (day, host, hour, kind, value): alerts, severe ones, the highest level, and sum and number of levels.

    Null values are kept as rows of their kind, for the alerts they stand for. Alerts without a time have no day and are
    left out.
    """
    hour, level = E.hour_start(F.col("ts")), F.col("level")
    values = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("value")) for i, c in enumerate(KINDS)])
    rows = alerts.where(F.col("ts").isNotNull()).select(
        hour.cast("date").alias(DAY), "agent", hour.alias("hour"), "level", F.inline(values)
    )
    return rows.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(level >= S.floor_of("high")).alias("high"), F.max(level).alias("top"),
        F.sum(level).alias("level_sum"), F.count(level).alias("level_n"),
    )


def _days_of(seen: DataFrame, days: list) -> DataFrame:
    return seen.where(F.col(DAY).isin(days)) if days else seen.where(F.lit(False))


def add_alerts(spark: SparkSession, alerts: DataFrame, path: str) -> list:
    """Add new alerts to the table at `path`, which need not exist; the days that were touched.

    Reads the stored rows of those days only. The days' number bounds what comes to the driver.
    """
    new = stored(seen_values(alerts))
    days = sorted(r[0] for r in new.select(DAY).distinct().collect())
    if not days:
        return []
    merged = new
    if _exists(spark, path):
        old = _days_of(read_seen(spark, path), days)
        merged = old.unionByName(new).groupBy(*_KEY).agg(*_sums())
    # Written beside the table first: its days cannot be read and replaced in one go.
    whole = stored(merged)
    whole.hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    return days


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_seen(spark: SparkSession, path: str, days: list | None = None) -> DataFrame:
    """The stored rows, of some days only if given."""
    seen = spark.read.parquet(path)
    return seen if days is None else _days_of(seen, days)


def features_of(
    seen: DataFrame,
    tactics: Sequence[str] = S.FEATURE_TACTICS,
    internal_prefix: str = S.INTERNAL_PREFIX,
    windows: Iterable[tuple[int, int, int]] = S.MAINTENANCE_WINDOWS,
) -> DataFrame:
    """The host-hour features, as `host_hour_features` makes them from the alerts."""
    kind, value = F.col("kind"), F.col("value")
    of = {c: kind == i for i, c in enumerate(KINDS)}
    base = of[KINDS[0]]

    def total(column: str, condition: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(base & condition, F.col(column))), F.lit(0).cast("bigint"))

    def distinct(column: str, condition: Column = F.lit(True)) -> Column:
        return F.count_if(of[column] & value.isNotNull() & condition)

    grouped = seen.groupBy("agent", "hour").agg(
        total("n").alias("alerts"),
        distinct("rule_id").alias("distinct_rules"),
        distinct("src_user").alias("distinct_users"),
        distinct("src_ip").alias("distinct_src_ips"),
        distinct("src_ip", E.is_external(value, internal_prefix)).alias("external_ips"),
        F.max(F.when(base, F.col("top"))).alias("max_level"),
        E.ratio(F.sum(F.when(base, F.col("level_sum"))), F.sum(F.when(base, F.col("level_n")))).alias("avg_level"),
        total("high").alias("high_sev_alerts"),
        distinct("mitre_tactic").alias("distinct_tactics"),
        *[total("n", value == t).alias(E.tactic_column(t)) for t in tactics],
    )
    timed = grouped.select("*", F.hour("hour").alias("hour_of_day"), E.iso_weekday(F.col("hour")).alias("weekday"))
    return timed.withColumn("maintenance_window", E.in_maintenance(F.col("weekday"), F.col("hour_of_day"), windows))
