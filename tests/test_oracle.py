"""Every registered query against its SQL on the small tables."""

import pytest
from compare import connect, differences, spark_rows, sql_rows

import __spark_entry__ as entry
from alertloom.verification import oracle, registry

# The smallest tables on which every statement gives rows.
SF = "/root/testdata/sf0.01"
QUERIES, SQL = registry.queries(), oracle.statements(registry.MIN_ALERTS)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_statement_has_a_query():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = spark_rows(df)
    assert rows[1] and differences(rows, sql_rows(con, SQL[name])) == []
    described = con.execute(f"describe {SQL[name]}").fetchall()
    theirs = {column: KINDS.get(kind, kind) for column, kind, *_ in described}
    assert {c: t.removesuffix("_ntz") for c, t in df.dtypes} == theirs
