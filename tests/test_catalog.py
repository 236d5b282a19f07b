import pytest

from gleaner.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(name, same):
    same(catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(name, spark, data):
    assert catalog.queries()[name](spark, data).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.queries())
