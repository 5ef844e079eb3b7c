"""Running aggregates along a time line, safe for keys that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000  # time is in microseconds

Agg = Callable[[Column], Column]


def slot_of(time: Column, width: int) -> Column:
    """Number of the slot of this width that `time` falls into, in exact integers."""
    return ((time - F.pmod(time, F.lit(width))) / F.lit(width)).cast("bigint")


def running(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    aggs: Mapping[str, Agg],
    slot_width: int = MICROS,
) -> DataFrame:
    """Replace each column of `aggs` by its running aggregate per key, in order of `time`.

    Rows at the same time see each other. The aggregates must combine (sum, max, min).

    One window per key would put a hot key into one task. Here time is cut into short slots. Each
    is reduced to one row on the map side, the slots of a key are run through in order, and what
    came before a slot reaches it as one extra row at its start. A task then holds either one row
    per slot of a key, or the rows of one slot.
    """
    table = rows.withColumn("_slot", slot_of(F.col(time), slot_width))

    def over(window) -> list[Column]:
        return [f(F.col(c)).over(window).alias(c) for c, f in aggs.items()]

    earlier = (
        Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        table.groupBy(*keys, "_slot")
        .agg(*[f(F.col(c)).alias(c) for c, f in aggs.items()])
        .select(*keys, "_slot", *over(earlier))
        .withColumn(time, F.col("_slot") * slot_width - 1)
        .withColumn("_carry", F.lit(True))
    )
    so_far = (
        Window.partitionBy(*keys, "_slot")
        .orderBy(time)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kept = [c for c in rows.columns if c not in aggs]
    return (
        table.withColumn("_carry", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .select(*kept, "_carry", *over(so_far))
        .filter(~F.col("_carry"))
        .drop("_carry")
    )
