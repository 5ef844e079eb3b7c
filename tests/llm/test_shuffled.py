"""Inputs that come out of a shuffle: parts of other sizes in every read must not change results."""

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from alertloom.llm import decontaminate, licenses, ngram_join, queries, warc
from alertloom.session import settled

SF = "/root/testdata/sf0.01"


@pytest.fixture
def small_parts(spark):
    """Parts are merged up to 300 KB of what is read, so that fewer columns make fewer parts."""
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    for key, value in zip(keys, ("300k", "false")):
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for key in keys:
        spark.conf.unset(key)


def documents(spark):
    return queries.table(spark, SF, "documents")


def shuffled(df, key):
    return df.dropDuplicates([key])


OPERATORS = {
    "licences": lambda d, b: licenses.find_licenses(d, windows=True),
    "components": lambda d, b: ngram_join.jaccard_components(d).drop("is_kept"),
    "contamination": decontaminate.contamination,
    "items": lambda d, b: decontaminate.find_items(d, b).select("doc_id", "n_words", F.array_sort("items").alias("items")),
    "no near copies": lambda d, b: ngram_join.drop_near_copies(d),
    "not contaminated": decontaminate.drop_contaminated,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_shuffled_documents_give_what_files_give(small_parts, name):
    spark = small_parts
    docs, benchmark = documents(spark), queries.table(spark, SF, "benchmark")
    assert docs.count() == docs.select("doc_id").distinct().count()
    expected = spark_rows(OPERATORS[name](docs, benchmark))
    assert expected[1] and spark_rows(OPERATORS[name](shuffled(docs, "doc_id"), benchmark)) == expected


def test_shuffled_pages_give_what_files_give(small_parts):
    pages = queries.table(small_parts, SF, "pages")
    assert spark_rows(warc.archive_round_trip(shuffled(pages, "page_id"))) == spark_rows(warc.archive_round_trip(pages))


def test_plain_files_are_not_written_again(spark):
    docs = documents(spark)
    for df in (docs, docs.select("doc_id", F.upper("text").alias("text")).where("doc_id > 3")):
        assert settled(df) is df
    for df in (docs.repartition(3), docs.orderBy("doc_id"), docs.where(F.rand() < 0.5), docs.limit(5), docs.join(docs.select("doc_id"), "doc_id")):
        assert settled(df) is not df
    assert spark.conf.get("spark.sql.files.minPartitionNum")
