import pytest

import check_queries

from arealis.plans import registry

DATA = "/root/testdata/sf0.001"
ENTRY = check_queries.load_entry()
registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES  # queries of the corpus operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(DATA)


def test_registry_is_consistent():
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
    assert set(ORACLES) <= set(QUERIES) <= set(ENTRY.queries())
    assert len(QUERIES) > 150


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0 and "Flag" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    ok, note = check_queries.compare(QUERIES[name](spark, DATA), duck, ORACLES[name])
    assert ok, note
    assert "TYPES" not in note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
