"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Day, hour and weekday buckets are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Join strategy, partition sizes and skewed join partitions are decided from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def sized_settings(shuffle_bytes: int, partition_mb: int = 128) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves up to `shuffle_bytes`.

    Shuffles start with enough partitions for each to fit in memory; adaptive execution merges those
    that turn out small, up to the target size.
    """
    target = partition_mb * 1024 * 1024
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(200, -(-shuffle_bytes // target))),
        "spark.sql.files.maxPartitionBytes": str(2 * target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "alertloom", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above; `shuffle_bytes` sizes it for its largest shuffle."""
    sized = {} if shuffle_bytes is None else sized_settings(shuffle_bytes)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine; on a cluster an
    unset folder is an error, because data written there would not survive a lost node.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="alertloom-")
        sc.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one, for all that it writes on the way."""
    return f"{shared_dir(spark)}/alertloom-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what this application has written on the way. Results still being read from it are lost.

    Call it after the last result was written elsewhere.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and continue from the written copy.

    Cuts the lineage like a checkpoint, but as Parquet: later steps read only their columns.
    """
    path = f"{scratch_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Plans of these alone read files again in the same parts.
_STEADY = {"Project", "Filter", "LogicalRelation", "LocalRelation"}


def settled(df: DataFrame) -> DataFrame:
    """`df` if it gives its rows in the same parts whenever it is read, else a written copy.

    Rows can only be numbered in one read and found by that number in another if parts stay what they are. Behind a
    shuffle their sizes depend on the columns that are read; of files, on the number of executors, so
    that number is held from here on. Nothing is written for plain files.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))

    def is_steady(plan) -> bool:
        children = plan.children()
        return plan.nodeName() in _STEADY and all(is_steady(children.apply(i)) for i in range(children.size()))

    plan = df._jdf.queryExecution().optimizedPlan()
    return df if plan.deterministic() and is_steady(plan) else stored(df)
