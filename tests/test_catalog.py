"""Every query with SQL agrees with it; the others give rows."""

import pytest

import __spark_entry__ as entry_module
from tallyforge.plans import catalog, model_queries
from compare import connect, difference

SMALL = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry_module.queries().items() if name in catalog.QUERIES}
ORACLES = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(catalog.QUERIES) == set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(spark, con, SMALL, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_without_sql_gives_rows(spark, name, monkeypatch):
    monkeypatch.setattr(model_queries, "SEARCH_SECONDS", 15.0)  # searches report what they have by then
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark, con):
    sql = ORACLES["popular_macro_auc"]
    assert difference(spark, con, SMALL, lambda s, _: entry_module.entry(s), sql) is None
    assert entry_module.entry(spark).first()["n_users"] > 0
