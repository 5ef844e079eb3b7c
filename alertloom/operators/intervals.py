"""Joins of points with the ranges they lie in, by equal keys and slots of time instead of a nested loop.

Time is cut into slots. A range stands in every slot that it touches, a point in one, and they meet by (key, slot).
Where a key has more points in a slot than one task should hold, its points are dealt over several salts, and the ranges
that ask for this slot stand in each of them. How many salts a slot needs comes from a count, so nothing is
copied for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.operators.timeline import slot_of

# Points of a key in a slot that are left together.
TOGETHER = 50_000


def _salts(n: Column, together: int) -> Column:
    return F.ceil(n / F.lit(together)).cast("int")


def points_in_ranges(
    points: DataFrame,
    ranges: DataFrame,
    keys: list[str],
    at: str,
    low: str,
    high: str,
    width: int,
    together: int = TOGETHER,
) -> DataFrame:
    """Every pair of a range and a point with equal `keys` and low <= at <= high: all columns of both.

    `at`, `low` and `high` are whole numbers, `width` is the length of a slot; ranges much longer than a slot stand in
    many. Null keys and null times match nothing. Columns other than the keys must differ in name. `points`
    and `ranges` are read twice: pass what is stored, or cheap to read.
    """
    given = [F.col(k).isNotNull() for k in keys]
    # Drawn where the points are read, so that copies of a row are dealt too, and alike if a task runs again.
    drawn = points.withColumn("_drawn", F.xxhash64(F.monotonically_increasing_id()))
    spots = drawn.where(F.col(at).isNotNull()).withColumn("_slot", slot_of(F.col(at), width))
    for known in given:
        spots = spots.where(known)
        ranges = ranges.where(known)
    slots = F.sequence(slot_of(F.col(low), width), slot_of(F.col(high), width))
    spans = ranges.where(F.col(low) <= F.col(high)).withColumn("_slot", F.explode(slots))
    place = [*keys, "_slot"]
    # Only slots that a range asks for are counted, and only their points are moved.
    asked = spans.select(*place).distinct()
    wanted = spots.join(asked, place, "left_semi")
    crowds = wanted.groupBy(*place).agg(_salts(F.count(F.lit(1)), together).alias("_salts")).where("_salts > 1")
    one = F.coalesce("_salts", F.lit(1))
    mixed = F.pmod(F.col("_drawn"), one.cast("bigint")).cast("int")
    dealt = wanted.join(crowds, place, "left").withColumn("_salt", mixed).drop("_salts", "_drawn")
    copied = spans.join(crowds, place, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_salts")
    inside = F.col(at).between(F.col(low), F.col(high))
    return dealt.join(copied, [*place, "_salt"]).where(inside).drop("_slot", "_salt")
