"""Every registered query against its SQL, on the smallest data folder."""

import pytest

import __spark_entry__ as spark_entry
import oracle_check
from textloom.plans import text_queries

SF = "/root/testdata/sf0.001"
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF)


def test_all_are_registered():
    assert set(text_queries.QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(text_queries.QUERIES))
def test_query(spark, duck, name):
    got = spark_entry.queries()[name](spark, SF).toArrow()
    assert got.num_rows > 0
    if name in ORACLES:
        want = duck.sql(ORACLES[name]).to_arrow_table()
        assert oracle_check.difference(got.to_pandas(), want.to_pandas()) is None
        assert oracle_check.type_difference(got.schema, want.schema) is None


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert sum(r["n_docs"] for r in rows) == 200
    assert max(r["max_seqlen"] for r in rows) <= 70


def test_oracles_have_queries():
    assert set(ORACLES) <= set(spark_entry.queries())
