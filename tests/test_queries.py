"""Every registered query with SQL gives the same rows as DuckDB; the others give rows."""

import pytest

from kinloom.plans import queries
from tests.oracle import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equal_to_sql(spark, db, name):
    assert difference(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF, db) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).head(1)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["source1_entity_id", "candidates"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
