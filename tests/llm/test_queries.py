"""The registered queries over the given tables, and the pipeline stage by stage."""

import re

import pytest
from compare import connect, differences, spark_rows, sql_rows
from pyspark.sql import functions as F
from test_decontaminate import brute as contaminated
from test_ngram_join import brute as grouped
from test_packing import check as packed
from tokenizers import Tokenizer

import corpus_pipeline
from alertloom.llm import queries, tokens

SF = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    rows = spark_rows(queries.queries()[name](spark, SF))
    assert rows[1] and differences(rows, sql_rows(con, SQL[name])) == []


@pytest.mark.parametrize("name", [f.__name__ for f in queries.OPERATORS])
def test_every_row_is_in_the_result(spark, name):
    source, key = {"op2": ("conversations", "conv_id"), "op3": ("pages", "page_id"), "op11": ("pages", "page_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    given = {r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()}
    assert {r[0] for r in queries.queries()[name](spark, SF).select(key).collect()} == given


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives, as lists of rows."""
    docs = queries.table(spark, SF, "documents").withColumn("extra", F.lit("x"))
    out = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{queries.warc.scratch_dir(spark)}/test-stage-{number}-{id(out)}"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows_of(df):
    return {r["doc_id"]: tuple(r) for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_stage_drops_what_the_query_rejects(spark, stages):
    kept = {r["doc_id"] for r in queries.op5_quality_rules(spark, SF).collect() if r["kept"]}
    assert rows_of(stages[1]) == {k: v for k, v in rows_of(stages[0]).items() if k in kept}
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(stages[0], "doc_id")
    long = [r["doc_id"] for r in clean.collect() if len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) >= 50]
    assert sum(i in kept for i in long) >= 0.98 * len(long)


def test_join_stage_keeps_one_of_each_group(stages):
    given = sorted(rows_of(stages[1]).values())
    _, groups = grouped(given)
    expected = {given[min(g)][0] for g in groups}
    assert rows_of(stages[2]) == {r[0]: r for r in given if r[0] in expected}
    assert len(expected) < len(given)


def test_join_stage_tells_and_takes_the_rule_of_op1(spark):
    told = corpus_pipeline.drop_near_copies.__doc__
    join = queries.ngram_join
    assert f"{join.SHINGLE} words a shingle, Jaccard of {join.PERCENT} percent" in told
    # One changed word of 55: 0.857 on 4 words a shingle. Of 51: 0.846, and 0.808 on 5 words, so only the general rule links them.
    words = [f"w{i}" for i in range(55)]
    near = [*words[:20], "odd", *words[21:]]
    apart = [f"v{i}" for i in range(51)]
    far = [*apart[:20], "odd", *apart[21:]]
    texts = [words, near, apart, far]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = f"{queries.warc.scratch_dir(spark)}/rule-{id(rows)}"
    docs.write.parquet(path)
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(path), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


def test_decontamination_stage_drops_the_contaminated(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = rows_of(stages[2])
    assert rows_of(stages[3]) == {k: v for k, v in given.items() if not contaminated(v[1], items)[4]}


def test_redaction_stage_changes_only_texts_with_personal_data(spark, stages):
    given, got = rows_of(stages[3]), rows_of(stages[4])
    spans = {r["doc_id"]: r["spans"] for r in queries.pii.private_data(stages[3]).collect()}
    assert set(got) == set(given) and any(spans.values())
    for k, v in got.items():
        assert (v == given[k]) == (not spans[k])
        for s in filter(None, spans[k].split(",")):
            kind, a, b = s.split(":")
            assert f"<{kind.upper()}>" in v[1] and given[k][1][int(a) : int(b)] not in v[1]


def test_packing_stage(stages):
    library = Tokenizer.from_file(tokens.vocabulary_path())
    packed([(k, v[1]) for k, v in rows_of(stages[4]).items()], stages[5].collect(), library, 1024)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_stages_on_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    queries.table(spark, SF, "documents").where("false").write.parquet(path)
    docs = spark.read.parquet(path)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
