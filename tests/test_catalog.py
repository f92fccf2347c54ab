import pytest
from oracle import duck, duck_rows, spark_rows

from sigloom import catalog


@pytest.fixture(scope="module")
def tables(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_oracle(spark, data, tables, name):
    assert spark_rows(catalog.QUERIES[name](spark, data)) == duck_rows(tables, catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_oracle_has_rows(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
