"""Exact interpolated quantiles of a weighted histogram."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.operators.timeline import running

SLOT = 3600  # histogram values per slot of the running count


def weighted_quantiles(
    histogram: DataFrame, key: str, value: str, weight: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """One row per key with a column per quantile, interpolated linearly between neighbours.

    `histogram` has one row per (key, integer value). Ranks come from a running count, so no task
    holds more than the values of one slot or the slots of one key, however wide the range is.
    """
    known = histogram.filter(F.col(value).isNotNull()).select(key, value, weight)
    counted = running(known.withColumn("_upto", F.col(weight)), [key], value, {"_upto": F.sum}, SLOT)
    totals = known.groupBy(F.col(key).alias("_key")).agg(F.sum(weight).alias("_n"))

    def position(p: float) -> Column:
        return (F.col("_n") - 1) * F.lit(p)

    def at(rank: Column) -> Column:
        """Smallest value with more than `rank` rows up to it."""
        return F.min(F.when(F.col("_upto") > rank, F.col(value))).cast("double")

    neighbours = [
        c
        for name, p in quantiles.items()
        for c in (
            at(F.floor(position(p))).alias(f"_lo_{name}"),
            at(F.ceil(position(p))).alias(f"_hi_{name}"),
        )
    ]
    found = (
        counted.join(totals, F.col(key).eqNullSafe(F.col("_key")))
        .groupBy(key)
        .agg(F.max("_n").alias("_n"), *neighbours)
    )
    return found.select(
        key,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (position(p) - F.floor(position(p)))
            ).alias(name)
            for name, p in quantiles.items()
        ],
    )
