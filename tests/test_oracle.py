"""Every query with SQL equals DuckDB on the same files."""

import pytest
from oracle_check import difference, oracle

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck(folder):
    return oracle(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, folder, duck, name):
    mine = entry.queries()[name](spark, folder).toPandas()
    assert difference(mine, duck.execute(entry.oracle_sql()[name]).df()) is None
    assert len(mine)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["semana", "pdv", "produto", "quantidade"]
