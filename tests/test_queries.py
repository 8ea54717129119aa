import pytest
from oracle import expected, got

from loomspark import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf, name):
    assert got(queries.QUERIES[name](spark, sf)) == expected(queries.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_other_queries_have_rows(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


def test_flagship(spark, sf):
    df = queries.flagship(spark, sf)
    assert df.count() > 0 and "c_mktsegment_target_mean" in df.columns
