"""Dense positions 1..n over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.session import stored

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row's index in its lower 33 bits


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Append `name` = position of the row in the total order given by `order`.

    One range-partitioned sort, written once: the written copy fixes which partition each row is
    in, so the row counts of the partitions and the rows themselves cannot disagree after a task
    is rerun. Only the table of counts, one row per partition, is summed up and broadcast.
    """
    placed = stored(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftright("_pos", _INDEX_BITS)
    index = F.col("_pos").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + index + 1).cast("bigint"))
        .drop("_part", "_pos", "_offset")
    )
