"""Columns that are computed once, however often later expressions use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with column `name`.

    The optimizer merges neighbouring projections, and with them repeats an expression wherever its column
    is used: for every element, if that is inside a function over an array. Generating one row for
    each row keeps the value instead.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
