"""Proportional stratified interleaving of documents into shards.

Rows are shuffled by a seeded hash within their source and numbered there. A row's fractional rank is
its number, plus a half, over the size of its source; in the order of this rank every stretch holds each
source in proportion. The order is cut into shards whose row counts differ by at most one, so each shard
has each source's share of rows to within two.

Defined cases: a null source is a source of its own; a null text has size 8 and the checksum of the empty
text. Rows equal in all columns read (doc_id, text, source) are interchangeable. Shards of a table with
fewer rows than shards may be empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.order import numbered
from alertloom.session import stored

SHARDS = 24
SEED = 20240229


def fractional_order(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, size, text_crc32, and `position` in the interleaved order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    mixed = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
    by_source = numbered(
        stored(narrow.withColumn("mixed", mixed)), ["source", "mixed", "doc_id", "text_crc32", "size"], "place"
    )
    sources = by_source.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    joined = by_source.alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source"))
    rank = (F.col("place") - F.col("first") + F.lit(0.5)) / F.col("rows")
    kept = ["doc_id", "size", "text_crc32", "mixed", "place"]
    ranked = joined.select(*kept, F.col("d.source").alias("source"), rank.alias("rank"))
    # Sources with equal ranks take turns by hash.
    order = ["rank", "mixed", "place"]
    return numbered(ranked, order, "position").drop("mixed", "place", "rank")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    ordered = fractional_order(docs, seed)
    rows = max(1, docs.count())
    # Shard s takes the positions from s * rows div shards on.
    shard = F.expr(f"({shards}L * (position + 1) - 1) div {rows}L").cast("int")
    first = F.expr(f"(shard * {rows}L) div {shards}")
    cut = ordered.withColumn("shard", shard)
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
