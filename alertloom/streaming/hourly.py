"""Alerts that keep arriving as files: hourly counts by severity, each alert counted once, late ones added.

Every batch writes the hours it changed, with their new counts, to a folder of its own number; a batch that runs again after
a failure replaces its folder. The counts of an hour are those of the last batch that changed it, so hours that are
still open are there too. State is bounded by the watermark: alerts that come later than `delay` after the latest
time seen are left out, and so is a second line of an alert within it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertloom import schemas as S
from alertloom.functions import exprs as E
from alertloom.sources import raw

COUNTS = "hour timestamp, severity string, alerts bigint"
BATCH = "batch"


def alert_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Alerts of all JSON-lines files in `folder`, and of those that come."""
    reader = spark.readStream.schema(S.RAW_ALERT).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return raw.flatten_alerts(reader.json(folder))


def hourly_severity(alerts: DataFrame, delay: str = "2 days") -> DataFrame:
    """(hour, severity, alerts), batch or stream. Alerts without a time are of no hour and are left out.

    Lines with one alert id count once, by the first that comes; those without an id count each.
    In a stream that holds for lines within `delay` of each other.
    """
    # A line without an id gets one of its own, as many lines may lack it.
    own = F.coalesce(F.col("alert_id"), F.concat(F.lit("\0"), F.uuid()))
    narrow = alerts.where(F.col("ts").isNotNull()).select(own.alias("id"), "ts", "level")
    if alerts.isStreaming:
        once = narrow.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])
    else:
        once = narrow.dropDuplicates(["id"])
    hour = F.window("ts", "1 hour")
    severity = E.severity_band(F.col("level")).alias("severity")
    counted = once.groupBy(hour.alias("w"), severity).agg(F.count(F.lit(1)).alias("alerts"))
    return counted.select(F.col("w.start").alias("hour"), "severity", "alerts")


def keep_hourly_severity(alerts: DataFrame, path: str, checkpoint: str, delay: str = "2 days") -> StreamingQuery:
    """Start counting what has arrived; ends by itself. Start it again with the same folders to go on."""

    def write(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    counts = hourly_severity(alerts, delay)
    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_hourly_severity(spark: SparkSession, path: str) -> DataFrame:
    """(hour, severity, alerts) as of the last batch."""
    rows = spark.read.schema(f"{COUNTS}, {BATCH} bigint").parquet(path)
    return rows.groupBy("hour", "severity").agg(F.max_by("alerts", BATCH).alias("alerts"))
