"""Every registered query against its SQL, or for rows where there is none."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    connection = duck("sf0.001")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    assert difference(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_has_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 30
    assert "mean_demand" in df.columns


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
