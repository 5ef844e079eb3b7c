"""Raw inputs: nested alert JSON lines, triage CSV and the ground-truth document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom import schemas as S

# Accepts milliseconds or microseconds and a numeric UTC offset: hours, with or without minutes and a colon.
ALERT_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]Z"
_COLON = r"([+-][0-9]{2}):([0-9]{2})$"
_HOURS = r"(?<upto>:[0-9]{2}(?:[.][0-9]+)?[+-][0-9]{2})$"


def _stamp() -> Column:
    return F.regexp_replace(F.regexp_replace("timestamp", _COLON, "$1$2"), _HOURS, "${upto}00")


# Alert column -> path in the raw record, for the columns that are copied unchanged.
_COPIED = {
    "rule_id": "rule.id",
    "rule_description": "rule.description",
    "agent": "agent.name",
    "src_ip": "data.srcip",
    "src_user": "data.srcuser",
    "dst_user": "data.dstuser",
    "location": "location",
}


def _first(values: str) -> Column:
    """First list element, NULL for a missing or empty list."""
    return F.try_element_at(F.col(values), F.lit(1))


def flatten_alerts(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Nested alert records to the flat alerts table.

    Strict fails on a value that cannot be converted; otherwise it becomes NULL.
    """
    stamp, level = _stamp(), F.col("rule.level")
    converted = {
        "alert_id": F.col("id"),
        "ts": F.to_timestamp(stamp, ALERT_TIME) if strict else F.try_to_timestamp(stamp, F.lit(ALERT_TIME)),
        "level": level.cast("int") if strict else level.try_cast("int"),
        "mitre_technique": _first("rule.mitre.id"),
        "mitre_tactic": _first("rule.mitre.tactic"),
        **{name: F.col(path) for name, path in _COPIED.items()},
    }
    return raw.select(*[converted[c].alias(c) for c in S.ALERTS.names])


def read_raw_alerts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One JSON object per line. Unknown keys are ignored, missing ones are NULL.

    Strict stops at a malformed line. Otherwise every record comes with its `line`, and the text of a
    malformed one is in `_corrupt_record` too; empty lines are skipped either way.
    """
    if strict:
        return spark.read.schema(S.RAW_ALERT).option("mode", "FAILFAST").json(path)
    schema = T.StructType([*S.RAW_ALERT.fields, T.StructField(S.CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT}
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("line"), F.from_json("value", schema, options).alias("r")).select(
        "line", "r.*"
    )


def load_alerts(spark: SparkSession, path: str) -> DataFrame:
    return flatten_alerts(read_raw_alerts(spark, path))


def load_alerts_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(alerts, rejects): lines that cannot be parsed or converted go to `rejects`.

    A reject carries its line, and the alert id where that could be read.
    """
    raw = read_raw_alerts(spark, path, strict=False)
    bad_time = F.try_to_timestamp(_stamp(), F.lit(ALERT_TIME)).isNull() & F.col("timestamp").isNotNull()
    bad_level = F.col("rule.level").isNotNull() & F.col("rule.level").try_cast("int").isNull()
    marked = raw.withColumn(
        "reason",
        F.when(F.col(S.CORRUPT).isNotNull(), "malformed line")
        .when(bad_time, "bad timestamp")
        .when(bad_level, "bad level"),
    )
    good = flatten_alerts(marked.filter(F.col("reason").isNull()), strict=False)
    rejects = marked.filter(F.col("reason").isNotNull()).select(
        F.col("id").alias("alert_id"), "line", "reason"
    )
    return good, rejects


def load_triage(spark: SparkSession, path: str) -> DataFrame:
    """Triage CSV with header. Ids stay text; times are zone-less; `True`/`False` become booleans."""
    raw = (
        spark.read.schema(S.RAW_TRIAGE)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRIAGE.fields])


TRUTH_DOCUMENT = T.StructType(
    [
        T.StructField("planted_alert_ids", T.ArrayType(T.StringType())),
        T.StructField("incidents", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRUTH_DOCUMENT).option("multiLine", True).option("mode", "FAILFAST").json(path)


def load_planted(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the alerts known to be malicious, one row per id."""
    return _truth(spark, path).select(F.explode("planted_alert_ids").alias("alert_id"))


def load_incidents(
    spark: SparkSession, path: str, hosts: dict[str, str] | None = None
) -> DataFrame:
    """(incident, agent, hour) of each known incident's first host-hour."""
    hosts = S.INCIDENT_HOSTS if hosts is None else hosts
    host_of = F.create_map(*[F.lit(x) for pair in hosts.items() for x in pair])
    return (
        _truth(spark, path)
        .select(F.explode("incidents").alias("incident", "hour_text"))
        .select(
            "incident",
            F.try_element_at(host_of, F.col("incident")).alias("agent"),
            F.to_timestamp("hour_text", "yyyy-MM-dd'T'HH").alias("hour"),
        )
    )
