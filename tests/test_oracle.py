import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .oracle_check import compare, connect

ORACLE = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, sf, con, key):
    assert compare(spark, con, sf, QUERIES[key], ORACLE[key]) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(queries())


@pytest.mark.parametrize("key", ["label_after_relabel", "model_reload"])
def test_saved_models_give_the_same_answers(spark, sf, key):
    rows = QUERIES[key](spark, sf)
    assert rows.count() == 200 and rows.where("not equal").count() == 0


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() == 60 and rows.columns == ["lang", "rank", "term", "weight"]
