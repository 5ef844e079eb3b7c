"""From raw documents to packed training sequences, one written stage after the other.

Each stage takes what the one before kept and returns the columns of documents, the last one packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from alertloom.llm import decontaminate, ngram_join, packing, pii, quality
from alertloom.llm.queries import prepare, table
from alertloom.session import scratch_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by the rule of op1: 4 words a shingle, Jaccard of 85 percent or more.

    The rule for stages without a contract, 5 words and 80 percent, is not taken: the stage and the query
    should call the same documents copies. Pairs that only that rule links all stay.
    """
    prepare(spark)
    return ngram_join.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark items."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts."""
    prepare(spark)
    return pii.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("best_fit_packing", pack),
]

# The fitted models and the tokenizer cannot be written in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each is written to the shared folder and read again."""
    folder = f"{scratch_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
