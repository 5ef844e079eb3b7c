"""Numbering the rows of a table in a sorted order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.session import stored

_IN_TASK = (1 << 33) - 1


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """`df` with a long column `name`: the row's number, from 0, in the given order.

    Rows are dealt by ranges of the order and sorted within them. The sorted rows are written once;
    what the parts before hold is added from one count for each part. Rows equal in the whole order
    must be interchangeable.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.withColumn(name, place))
    part = F.shiftright(name, 33)
    # One row for each part: the broadcast side is bounded by the number of tasks.
    counts = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n")).collect()
    before, parts = 0, []
    for r in sorted(counts, key=lambda r: r["__part"]):
        parts.append((r["__part"], before))
        before += r["__n"]
    offsets = df.sparkSession.createDataFrame(parts, "__part long, __before long")
    joined = rows.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    number = F.col("__before") + F.col(name).bitwiseAND(F.lit(_IN_TASK))
    return joined.withColumn(name, number).drop("__part", "__before")
