"""Stored tables: Parquet layout for alerts and triage, replacing days, optional bucketing, load counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from alertloom.functions import exprs as E

DAY = "day"


def _by_day(rows: DataFrame, time: str) -> DataFrame:
    """Rows with their UTC day. Rebalancing gathers a day into few files and splits one that is too large for one task."""
    return rows.withColumn(DAY, E.instant(F.col(time)).cast("date")).hint("rebalance", F.col(DAY))


def _watched(rows: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """`rows` with `metrics` observed on the way to the sink, `row_count` always.

    Observed last, in the tasks that write: Spark counts such a task once, also if it runs again after a lost executor.
    """
    seen = Observation()
    named = [c.alias(name) for name, c in metrics.items()]
    return rows.observe(seen, F.count(F.lit(1)).alias("row_count"), *named), seen


def write_alerts(alerts: DataFrame, path: str) -> int:
    """Replace the alerts table, one folder per UTC day so that time filters prune folders. Gives the number of rows."""
    rows, seen = _watched(_by_day(alerts, "ts"))
    rows.write.mode("overwrite").partitionBy(DAY).parquet(path)
    return seen.get["row_count"]


def write_triage(triage: DataFrame, path: str) -> int:
    """Replace the triage table. Gives the number of rows."""
    rows, seen = _watched(triage)
    rows.write.mode("overwrite").parquet(path)
    return seen.get["row_count"]


def replace_days(rows: DataFrame, path: str, first: dt.date, last: dt.date, time: str = "ts") -> int:
    """Replace the days from `first` to `last`, both included, of a table with day folders. Gives the number of rows.

    `time` is the column the days come from: `ts` of alerts, `opened_at` of triage. Rows of other days, and those without
    a time, are not written, so a run for some days changes no other. Files are staged and moved when all
    tasks are done; a run that fails before that leaves the table as it was. Days that `rows` no longer
    has are emptied after that, so a second run of the same days gives the same table.
    """
    span = first.isoformat(), last.isoformat()
    day = E.instant(F.col(time)).cast("date")
    within = _by_day(rows.where(day.between(*[F.lit(d).cast("date") for d in span])), time)
    # At most one value for each day of the span.
    watched, seen = _watched(within, days=F.collect_set(F.col(DAY).cast("string")))
    watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    _empty_days(rows.sparkSession, path, span, set(seen.get["days"]))
    return seen.get["row_count"]


def _empty_days(spark: SparkSession, path: str, span: tuple[str, str], kept: set[str]) -> None:
    """Delete the folders of the days in `span` that are not in `kept`."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(root) if files.exists(root) else ():
        name = folder.getPath().getName()
        day = name.removeprefix(f"{DAY}=")
        if day != name and span[0] <= day <= span[1] and day not in kept:
            files.delete(folder.getPath(), True)


def read_alerts(
    spark: SparkSession, path: str, since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """The alerts table, from `since` (included) to `until` (excluded), both in UTC.

    Only the folders of those days are read.
    """
    return _between(spark.read.parquet(path), "ts", since, until)


def read_triage_days(
    spark: SparkSession, path: str, since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """Triage stored by `replace_days`, opened from `since` (included) to `until` (excluded); reads those days only."""
    return _between(spark.read.parquet(path), "opened_at", since, until)


def _between(rows: DataFrame, time: str, since: dt.datetime | None, until: dt.datetime | None) -> DataFrame:
    at = E.instant(F.col(time))
    if since is not None:
        rows = rows.filter((F.col(DAY) >= F.lit(since.date())) & (at >= _utc(since)))
    if until is not None:
        rows = rows.filter((F.col(DAY) <= F.lit(until.date())) & (at < _utc(until)))
    return rows.drop(DAY)


def _utc(moment: dt.datetime) -> Column:
    return E.instant(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "alert_id") -> None:
    """Replace a catalog table bucketed and sorted by `key`.

    With alerts and triage bucketed alike, the joins between them neither move nor sort alerts. Rows are
    gathered by bucket first, so that a bucket is one file; rows without a key, which join with
    nothing, are spread over the tasks. There are no day folders here: they would multiply the
    number of files and break the order within a bucket. For reading by time, use `write_alerts`.
    """
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = df.repartition(buckets, key, spread)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def load_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, row_count) per loaded table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def observed_counts(spark: SparkSession, **rows: int) -> DataFrame:
    """(table_name, row_count) from what the writers counted, without another pass over the tables."""
    return spark.createDataFrame(list(rows.items()), "table_name string not null, row_count bigint not null")
