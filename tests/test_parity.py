"""Every query against its SQL on the smallest fixture."""

import pytest

from parity import compare, connect

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toArrow()
    problems = compare(got, con.sql(ORACLES[name]).to_arrow_table())
    assert not [p for p in problems if not p.startswith("note")]


def test_entry_answers_every_question(spark, sf):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "doc_id", "score", "matched", "answer"]
    assert df.count() == spark.read.parquet(f"{sf}/benchmark.parquet").count()
