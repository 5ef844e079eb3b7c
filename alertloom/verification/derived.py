"""`alerts`, `triage` and a ground truth derived from the generic `events` table.

The same derivation exists as a SQL prefix in `oracle.py`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.session import configure

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# A stretch of the events' time that starts and ends within a day.
DAYS = (dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 12, 18, 30))

# Alerts taken as malicious: the highest level, from one rule.
PLANTED_LEVEL, PLANTED_RULE = 15, "error"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    tactic = F.element_at(F.array(*map(F.lit, S.FEATURE_TACTICS)), F.col("k") % 13 + 1)
    text = F.col("k").cast("string")
    return events.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("alert_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("rule_id"),
        F.least(F.lit(15), 3 + F.floor(F.col("value") / 16)).cast("int").alias("level"),
        F.concat(F.lit("rule "), "event_type").alias("rule_description"),
        F.when(F.col("k") % 13 < 8, F.concat(F.lit("T"), (1000 + F.col("k") % 50).cast("string"))).alias(
            "mitre_technique"
        ),
        F.when(F.col("k") % 13 < 8, tactic).alias("mitre_tactic"),
        F.concat(F.lit("host-"), (F.col("k") % 12).cast("string")).alias("agent"),
        F.when(F.col("k") % 5 == 0, None)
        .when(F.col("k") % 2 == 0, F.concat(F.lit("10.10.0."), text))
        .otherwise(F.concat(F.lit("185.220.0."), text))
        .alias("src_ip"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("src_user"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("t"), (F.col("event_id") % 9).cast("string"))).alias(
            "dst_user"
        ),
        F.concat(F.lit("/var/log/"), "event_type", F.lit("-"), (F.col("k") % 3).cast("string")).alias("location"),
    )


def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    wait = F.floor(F.col("value") * 37).cast("int")
    work = (F.col("event_id") % 40 * 30).cast("int")
    real = F.col("user_id") % F.when(F.col("event_type") == "view", 50).otherwise(10) == 0
    level = F.least(F.lit(15), 3 + F.floor(F.col("value") / 16)).cast("int")

    def after(seconds: Column) -> Column:
        zero = F.lit(0)
        return F.col("ts") + F.make_dt_interval(zero, zero, zero, seconds)

    return events.filter(F.col("event_id") % 3 != 0).select(
        F.col("event_id").cast("string").alias("alert_id"),
        after(wait).cast("timestamp_ntz").alias("opened_at"),
        after(wait + work).cast("timestamp_ntz").alias("closed_at"),
        F.concat(F.lit("an-"), (F.col("event_id") % 4).cast("string")).alias("analyst"),
        F.when(real, S.TRUE_POSITIVE)
        .when(F.col("user_id") % 10 < 4, "benign")
        .otherwise(S.FALSE_POSITIVE)
        .alias("disposition"),
        (real & (level >= 9)).alias("escalated"),
    )


def triage_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triage log where some alerts were taken up again by another analyst, and some rows came twice."""
    once = triage(spark, sf_dir)
    number = F.col("alert_id").cast("bigint")
    again = once.where(number % 7 == 0).select(
        "alert_id",
        (F.col("opened_at") + F.expr("interval 1 hour")).alias("opened_at"),
        (F.col("closed_at") + F.expr("interval 2 hours")).alias("closed_at"),
        F.lit("an-9").alias("analyst"),
        F.lit("benign").alias("disposition"),
        F.lit(False).alias("escalated"),
    )
    return once.unionByName(again).unionByName(once.where(number % 11 == 0))


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alerts(spark, sf_dir)
    return a.filter((F.col("level") >= PLANTED_LEVEL) & (F.col("rule_id") == PLANTED_RULE)).select(
        "alert_id"
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each host's first hour with a malicious alert."""
    a = alerts(spark, sf_dir)
    return (
        a.join(planted(spark, sf_dir), "alert_id", "left_semi")
        .groupBy("agent")
        .agg(F.min(E.hour_start(F.col("ts"))).alias("hour"))
        .select(F.concat(F.lit("first_on_"), "agent").alias("incident"), "agent", "hour")
    )


def raw_alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts as nested JSON text, one object per line, with keys the loader ignores."""
    a = alerts(spark, sf_dir)
    listed = F.when(F.col("mitre_tactic").isNotNull(), F.array("mitre_tactic"))
    mitre = F.struct(F.array("mitre_technique").alias("id"), listed.alias("tactic"))
    return a.select(
        F.to_json(
            F.struct(
                F.col("alert_id").alias("id"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ").alias("timestamp"),
                F.struct(
                    F.col("rule_id").alias("id"),
                    "level",
                    F.col("rule_description").alias("description"),
                    F.array(F.lit("derived")).alias("groups"),
                    F.when(listed.isNotNull(), mitre).alias("mitre"),
                ).alias("rule"),
                F.struct(F.lit("001").alias("id"), F.col("agent").alias("name")).alias("agent"),
                F.struct(
                    F.col("src_ip").alias("srcip"),
                    F.col("src_user").alias("srcuser"),
                    F.col("dst_user").alias("dstuser"),
                ).alias("data"),
                "location",
            )
        ).alias("value")
    )


# Planted ids in one document of the ground truth.
IDS_PER_DOCUMENT = 10_000


def truth_document(spark: SparkSession, sf_dir: str, most: int = IDS_PER_DOCUMENT) -> DataFrame:
    """The ground truth as JSON documents: each incident's first hour in one, at most `most` ids in each other.

    Planted alerts are a share of all alerts: they are grouped by their place in a partition, so that neither a
    group nor a document grows with the table. Incidents are one for each host.
    """
    hours = F.collect_list(F.struct("incident", F.date_format("hour", "yyyy-MM-dd'T'HH")))
    named = incidents(spark, sf_dir).agg(F.map_from_entries(hours).alias("incidents"))
    # The partition's number is in the upper bits, the place in it in the lower 33.
    placed = planted(spark, sf_dir).withColumn("place", F.monotonically_increasing_id())
    part, bucket = F.shiftright("place", 33), F.floor(F.col("place").bitwiseAND((1 << 33) - 1) / most)
    found = placed.groupBy(part.alias("part"), bucket.alias("bucket")).agg(
        F.array_sort(F.collect_list("alert_id")).alias("planted_alert_ids")
    )
    return named.select(F.to_json(F.struct("incidents")).alias("value")).unionByName(
        found.select(F.to_json(F.struct("planted_alert_ids")).alias("value"))
    )


# The host of each incident, as the loader is told it.
INCIDENT_HOSTS = {f"first_on_host-{i}": f"host-{i}" for i in range(12)}
