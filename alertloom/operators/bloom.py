"""Joins that drop most rows without a partner before they are moved.

The ids of the small side are put into a Bloom filter: every id chooses one 64-bit word and sets five bits of it.
The filter is sized from a count of the ids, its words are combined in the tasks, and it goes to all tasks as one array
of at most `most_words` words. A row passes if the five bits of its id are set, which is one look-up per row, inside
the scan's stage. What passes by chance falls out in the join that follows, so results are those of the join alone.
If the ids need more words than that, they get fewer bits each; from under eight bits on a filter would hardly
help any more, and the rows are joined as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 24
LEAST_BITS = 8
# 32 MB.
MOST_WORDS = 1 << 22
_SET = 5


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), key), F.lit(words))


def _mask(key: Column) -> Column:
    """The bits of an id: five places from six bits of its hash each."""
    hashed = F.xxhash64(F.lit("bits"), key)
    mask = F.lit(0).cast("bigint")
    for i in range(_SET):
        place = F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def filter_size(ids: int, bits_per_id: int = BITS_PER_ID, most_words: int = MOST_WORDS) -> int | None:
    """Words of a filter for so many ids, or None if the most words are too few to be of use."""
    words = max(1, -(-ids * bits_per_id // 64))
    if words <= most_words:
        return words
    return most_words if 64 * most_words >= LEAST_BITS * ids else None


def filter_words(ids: DataFrame, key: str, words: int) -> DataFrame:
    """One row with the filter, an array of `words` longs."""
    known = ids.where(F.col(key).isNotNull())
    # Combined in the tasks: at most one row per word and task is moved.
    made = known.groupBy(_word(F.col(key), words).alias("word")).agg(F.bit_or(_mask(F.col(key))).alias("bits"))
    every = ids.sparkSession.range(words).withColumnRenamed("id", "word")
    filled = every.join(made, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(listed, lambda x: x["bits"]).alias("words"))


def may_match(
    rows: DataFrame, ids: DataFrame, key: str, bits_per_id: int = BITS_PER_ID, most_words: int = MOST_WORDS
) -> DataFrame:
    """`rows` without most of those whose `key` is not in `ids`; none that is in there is dropped.

    Rows with a null key match nothing and are dropped. Runs a job that counts the ids.
    """
    words = filter_size(ids.where(F.col(key).isNotNull()).count(), bits_per_id, most_words)
    known = rows.where(F.col(key).isNotNull())
    if words is None:
        return known
    mask = _mask(F.col(key))
    found = F.get(filter_words(ids, key, words).scalar(), _word(F.col(key), words).cast("int"))
    return known.where(found.bitwiseAND(mask) == mask)


def bloom_join(
    rows: DataFrame, others: DataFrame, key: str, bits_per_id: int = BITS_PER_ID, most_words: int = MOST_WORDS
) -> DataFrame:
    """The inner join of `rows` with the smaller `others` on `key`."""
    return may_match(rows, others, key, bits_per_id, most_words).join(others, key)
