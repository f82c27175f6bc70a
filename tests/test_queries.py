import pytest
from compare import rows_of, sql_rows
from compare import DATA

from genospark.plans import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, duck, name):
    assert rows_of(queries.QUERIES[name](spark, f"{DATA}/sf0.001")) == sql_rows(duck, oracle.SQL[name])


def test_every_query_has_sql_or_a_test():
    assert set(queries.QUERIES) - set(oracle.SQL) == {"a21_sample_pca", "q4_em_converged", "q7_vst_transform"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
