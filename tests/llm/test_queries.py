import pytest

from gleaner.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(name, same):
    same(Q.queries()[name], Q.oracle_sql()[name])


COLUMNS = {"p1_found": ["row_no"], "p2_found": ["row_no"], "p3_found": ["row_no"], "p4_found": ["row_a", "row_b"], "p5_found": ["row_no"], "p6_ids": ["doc_id", "ids"]}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_no_repeats(name, spark, data):
    df = Q.queries()[name](spark, data)
    assert df.columns == COLUMNS[name]
    assert df.count() == df.distinct().count() > 0
    assert all(t == "bigint" for c, t in df.dtypes if c != "ids")
